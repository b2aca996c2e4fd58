"""Operator 5: quality rules with adaptive thresholds.

Fixed base rules throw out broken texts. The verdict on the others compares
each measure with thresholds learned from the documents themselves, per
language and source: the quantile :data:`TAIL` at either end, but no closer to
the median than :data:`FLOOR`. Where junk is more than a tail of its group, the
limit is median plus or minus :data:`SPREADS` times the distance between the
median and the quartile on that side (:data:`SLACK` at least). Quantiles come from a
mergeable sketch: counts of logarithmic bins (16 per power of two, so at most
1/16 relative error), which add up over tasks, sources and languages in any
order, with the same result whatever executors are lost. A group with fewer
than :data:`LEAST_ROWS` documents uses the merged sketch of its language, and
that of all documents if the language is small too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Words, map_texts, mix, store

SYMBOLS = "#*$%&|<>"
LEAST_ROWS = 200
SPREADS = 8
MEASURES = ("symbol_rate", "dup_line_rate", "repeat_rate", "word_length")
#: Share of a group's documents beyond the limit at either end.
TAIL = 0.01
#: Smallest distance from the median that can fail, in the measure's unit.
FLOOR = {"symbol_rate": 50, "dup_line_rate": 50, "repeat_rate": 50, "word_length": 30}
#: Least width of the limit by quartiles, as most quartiles are all 0.
SLACK = {"symbol_rate": 250, "dup_line_rate": 300, "repeat_rate": 180, "word_length": 300}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
BROADCAST_ROWS = 100_000
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_WORD = np.uint64(0xD1342543DE82EF95)


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def repeated_words(words: Words, width: int = 5) -> np.ndarray:
    """Per text, the words that lie in a ``width``-word window that the text
    has twice or more."""
    h, n = words.hash, len(words.hash) - width + 1
    covered = np.zeros(len(h), dtype=bool)
    if n > 0:
        doc = words.doc()
        rolled = mix(doc[:n].astype(np.uint64) + np.uint64(1))
        for k in range(width):
            rolled = mix(rolled * _WORD + h[k:n + k])
        at = np.flatnonzero(doc[:n] == doc[width - 1:])
        order = at[np.argsort(rolled[at], kind="stable")]
        same = rolled[order[1:]] == rolled[order[:-1]]
        twice = np.zeros(n, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(width):
            covered[k:n + k] |= twice
    return _sums(covered, words.first)


def lines_of(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    seen: set[str] = set()
    n = 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            n += 1
            seen.add(line)
    return n, n - len(seen)


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` with the counts of each text. A NULL text has no
    words and no lines."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = StructType([*[f for f in rows.schema.fields[:-1]],
                         *[StructField(c, LongType()) for c in COUNTS]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch["_text"], lower=False)
        data, at = words.data, words.text_at
        is_point = (data & 0xC0) != 0x80
        white = (data == 32) | ((data >= 9) & (data <= 13))
        lines = [lines_of(t) for t in batch["_text"].to_pylist()]
        values = (np.diff(words.first), _sums(is_point & ~white, at), _sums(_SYMBOL[data], at),
                  np.array([x[1] for x in lines]), repeated_words(words),
                  np.array([x[0] for x in lines]))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(v, pa.int64()) for v in values]],
            [*batch.schema.names[:-1], *COUNTS])

    return map_texts(rows, "_text", schema, run)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _measures() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    whole = lambda top, low: F.floor(top / low).cast("long")
    return {"symbol_rate": whole(F.col("n_symbols") * 1000, words),
            "dup_line_rate": whole(F.col("n_dup_lines") * 1000, lines),
            "repeat_rate": whole(F.col("n_repeat_words") * 1000, words),
            "word_length": whole(F.col("word_chars") * 100, words)}


def bin_of(value: Column) -> Column:
    """Sketch bin of a whole number: exact below 32, then 16 a power of two."""
    power = F.length(F.bin(value)) - 1
    part = F.floor(value / F.pow(F.lit(2.0), power - 4)).cast("long")
    return F.when(value < 32, value).otherwise(16 * (power - 4) + part)


def value_of(bin_: Column) -> Column:
    """Lower end of a bin."""
    power = F.floor((bin_ - 16) / 16)
    return F.when(bin_ < 32, bin_).otherwise(
        ((bin_ - 16 * power) * F.pow(F.lit(2.0), power)).cast("long"))


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """``level, lang, source, measure, bin, n``: sketches of the documents that
    pass the base rules, per language and source (level 2), per language (1)
    and of all (0). Counted once, then merged by adding."""
    bins = F.array(*[F.struct(F.lit(k).alias("measure"), bin_of(v).alias("bin"))
                     for k, v in _measures().items()])
    rows = measured.filter(~base_failed()).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(bins).alias("_"))
    fine = rows.groupBy("lang", "source", F.col("_.measure").alias("measure"),
                        F.col("_.bin").alias("bin")).agg(F.count("*").alias("n"))
    levels = F.explode(F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), F.lit(None).cast("string").alias("s")),
        F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("l"),
                 F.lit(None).cast("string").alias("s"))))
    return (fine.select(levels.alias("at"), "measure", "bin", "n")
            .groupBy(F.col("at.level").alias("level"), F.col("at.l").alias("lang"),
                     F.col("at.s").alias("source"), "measure", "bin")
            .agg(F.sum("n").alias("n")))


def limits(sketch: DataFrame) -> DataFrame:
    """``level, lang, source, n, lows, highs``: thresholds per group, in the
    order of :data:`MEASURES`. A window sees the bins of one measure and group,
    a few hundred rows at most."""
    group = ("level", "lang", "source", "measure")
    order = Window.partitionBy(*group).orderBy("bin")
    ranked = sketch.select(*group, value_of(F.col("bin")).alias("value"), "n",
                           (value_of(F.col("bin") + 1) - 1).alias("last"),
                           F.sum("n").over(order).alias("upto"),
                           F.sum("n").over(Window.partitionBy(*group)).alias("total"))

    def quantile(p: float, end: str = "value") -> Column:
        return F.min(F.when(F.col("upto") >= F.lit(p) * F.col("total"), F.col(end)))

    q = ranked.groupBy(*group).agg(F.max("total").alias("n"), quantile(0.25).alias("q1"),
                                   quantile(0.5).alias("q2"), quantile(0.75).alias("q3"),
                                   quantile(TAIL).alias("first"), quantile(1 - TAIL, "last").alias("last"))

    def of_measure(table: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("measure")]

    slack, floor = of_measure(SLACK), of_measure(FLOOR)
    ends = q.select(
        *group, "n",
        F.greatest(F.col("q2") - F.greatest(SPREADS * (F.col("q2") - F.col("q1")), slack),
                   F.least("first", F.col("q2") - floor)).alias("low"),
        F.least(F.col("q2") + F.greatest(SPREADS * (F.col("q3") - F.col("q2")), slack),
                F.greatest("last", F.col("q2") + floor)).alias("high"))

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("measure") == name, F.col(column)))

    return ends.groupBy("level", "lang", "source").agg(
        F.max("n").alias("n"), F.array(*[of(m, "low") for m in MEASURES]).alias("lows"),
        F.array(*[of(m, "high") for m in MEASURES]).alias("highs"))


def with_verdict(measured: DataFrame, ends: DataFrame, lang: str, source: str) -> DataFrame:
    """The measured rows with ``base_failed`` and ``kept``."""
    small = ends.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def level(k: int) -> DataFrame:
        part = ends.filter((F.col("level") == k) & (F.col("n") >= (LEAST_ROWS if k else 0))).select(
            F.col("lang").alias(f"_l{k}"), F.col("source").alias(f"_s{k}"),
            F.struct("lows", "highs").alias(f"_e{k}"))
        return F.broadcast(part) if small else part

    out = measured.join(level(2), F.col(lang).eqNullSafe(F.col("_l2"))
                        & F.col(source).eqNullSafe(F.col("_s2")), "left")
    out = out.join(level(1), F.col(lang).eqNullSafe(F.col("_l1")), "left")
    whole = ends.filter("level = 0").select(F.struct("lows", "highs").alias("_e0")).first()
    top = F.lit(None) if whole is None else F.struct(
        F.lit(list(whole[0]["lows"])).alias("lows"), F.lit(list(whole[0]["highs"])).alias("highs"))
    found = F.coalesce("_e2", "_e1", top.cast("struct<lows:array<bigint>,highs:array<bigint>>"))
    inside = F.lit(True)
    for k, value in enumerate(_measures().values()):
        inside &= value.between(F.col("_e")["lows"][k], F.col("_e")["highs"][k])
    return (out.withColumn("_e", found).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
            .drop(*[f"_{x}{k}" for x in "lse" for k in (1, 2)], "_e"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document.

    * NULL or blank text: no words, fails the base rules.
    * A NULL language or source is a group of its own.
    * Equal measures get equal verdicts; repeated rows are judged each.
    * No rows: no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"),
                       F.col(source).cast("string").alias("source"))
    measured = store(measure(rows, "text", ("doc_id", "lang", "source")))
    ends = store(limits(sketches(measured, "lang", "source")))
    return with_verdict(measured, ends, "lang", "source").drop("lang", "source")
