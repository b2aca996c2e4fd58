"""Operator 3: language identification by bit-sliced Bloom filters.

One Bloom filter per language, stored transposed: position ``p`` of all filters
is one word whose bit ``l`` belongs to language ``l``. The AND of a few such
words tells at once which languages contain an n-gram. A text is scored by
counting, per language, the n-grams found; the count is corrected for the
filter's false positives, which are known from its fill.

The profiles hold at most ``most_grams`` n-grams per language and ``most_model``
in all, so the model has a fixed size limit and may be broadcast. :func:`keep_known`
learns them from every labelled row, :func:`identify` from a bounded sample (at most
``most_rows``, an equal part for each language, by a hash of text and key). Any number of languages up to
:data:`MOST_LANGUAGES` is told apart; more labels are refused.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import few_files, free_name, map_texts, mix, remainder, store

GRAMS = (2, 3, 4)
UNKNOWN = "und"
MOST_LANGUAGES = 4096
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_BATCH = 1 << 20
#: Parts of a language that are ranked apart before its most frequent grams are.
_SLICES = 16


def gram_hashes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the 2-, 3- and 4-grams of letters of each text, one width at a
    time, and where each text begins. Everything but letters is one blank; grams do
    not span texts."""
    pieces = [" " + " ".join(t.lower().split()) + " \x00" for t in texts]
    points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    first = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    # ASCII that is not a letter counts as a blank
    points = np.where((points < 65) & (points > 0) | (points > 90) & (points < 97)
                      | (points > 122) & (points < 128), np.uint32(32), points).astype(np.uint64)
    left = (np.repeat(first[1:], np.diff(first)) - np.arange(len(points))).astype(np.int32)
    blank = points == 32
    blank[:-1] &= blank[1:]
    rolled = points
    for width in range(2, max(GRAMS) + 1):
        rolled = rolled[:max(len(points) - width + 1, 0)] * _MULTIPLY + points[width - 1:]
        if width not in GRAMS:
            continue
        n = len(rolled)
        keep = (left[:n] > width) & ~blank[:n]
        begin = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[np.minimum(first, n)]
        yield mix(rolled[keep] ^ np.uint64(width)), begin


@dataclass(frozen=True)
class Model:
    """Bit-sliced filters of all languages and their false positive rates.

    ``slices`` has a row per filter position and a word per 8 or 64 languages:
    bit ``l`` of a row tells whether language ``l`` has set that position.
    """

    languages: tuple[str, ...]
    slices: np.ndarray
    hashes: int
    false_positive: np.ndarray
    prior: np.ndarray

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], prior: dict[str, float], hashes: int = 4) -> Model:
        """Filters of the grams of each language, a few per cent full."""
        languages = tuple(sorted(grams))
        most = max((len(g) for g in grams.values()), default=0)
        size = 1 << max(6, math.ceil(math.log2(13 * hashes * most + 1)))
        dtype = np.uint8 if len(languages) <= 8 else np.uint64
        width = 8 * dtype().itemsize
        slices = np.zeros((size, max(1, -(-len(languages) // width))), dtype)
        fill = np.zeros(len(languages))
        for k, name in enumerate(languages):
            at = np.unique(np.concatenate(list(positions(grams[name], size, hashes))))
            slices[at, k // width] |= dtype(1 << k % width)
            fill[k] = len(at) / size
        return cls(languages, slices, hashes, fill ** hashes,
                   np.array([float(prior.get(k, 0)) for k in languages]))

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """Bit mask of the languages that hold each gram, a row of words each."""
        masks = (self.slices[at] for at in positions(grams, len(self.slices), self.hashes))
        out = next(masks)
        for mask in masks:
            out &= mask
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits per text and language, and the grams looked up."""
        found = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        width = 8 * self.slices.dtype.itemsize
        for grams, first in gram_hashes(texts):
            mask = self.lookup(grams)
            total += np.diff(first)
            for k in range(len(self.languages)):
                own = (mask[:, k // width] >> mask.dtype.type(k % width)) & mask.dtype.type(1)
                hits = np.concatenate([[0], np.cumsum(own, dtype=np.int32)])
                found[:, k] += hits[first[1:]] - hits[first[:-1]]
        corrected = (found - total[:, None] * self.false_positive) / (1 - self.false_positive)
        return np.maximum(corrected, 0.0), total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and evidence. The score is the share of the best language
        among all languages' corrected hits; the evidence its hits among the grams of
        the text, plus what chance may take from a text of few grams (one over
        the root of their number). Ties go to the language with more training
        rows, then the smaller name."""
        plain = [t or "" for t in texts]
        corrected, total = self.counts(plain)
        names, scores, evidence = [], np.zeros(len(plain)), np.zeros(len(plain))
        # the last of this order is the best; a later one wins only if it is better
        order = np.lexsort((-np.arange(len(self.languages)), self.prior))[::-1]
        for k, text in enumerate(plain):
            if not self.languages or not _LETTER.search(text):
                names.append(UNKNOWN)
                continue
            row = corrected[k]
            best = order[int(np.argmax(row[order]))]
            names.append(self.languages[best])
            hits = row.sum()
            scores[k] = row[best] / hits if hits > 0 else 1.0 / len(row)
            evidence[k] = row[best] / total[k] + total[k] ** -0.5 if total[k] else 1.0
        return names, scores, evidence


def positions(grams: np.ndarray, size: int, hashes: int) -> Iterator[np.ndarray]:
    """The filter positions of each gram, one hash at a time; ``size`` is a power of two."""
    last = np.uint64(size - 1)
    step = (grams >> np.uint64(32)) | np.uint64(1)
    for k in range(hashes):
        yield ((grams + np.uint64(k) * step) & last).astype(np.int64)


def _grams_of(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Gram counts per language of a batch of labelled texts."""
    encoded = batch["lang"].dictionary_encode()
    codes = encoded.indices.to_numpy()
    langs, values, counts = [], [], []
    for code, name in enumerate(encoded.dictionary.to_pylist()):
        texts = batch["text"].filter(pa.array(codes == code)).to_pylist()
        for grams, _ in gram_hashes(texts):
            value, n = np.unique(grams, return_counts=True)
            langs += [name] * len(value)
            values.append(value.view(np.int64))
            counts.append(n)
    if not values:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(np.concatenate(values)),
         pa.array(np.concatenate(counts).astype(np.int64))], ["lang", "gram", "n"])


def labelled(docs: DataFrame, text: str = "text", lang: str = "lang",
             key: Sequence[str] = ()) -> tuple[DataFrame, dict[str, int]]:
    """``text, lang, place`` of all labelled rows, and their number per language;
    ``place`` is a hash of ``key`` and text."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                       F.xxhash64(*key, text).alias("place")).dropna()
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).take(MOST_LANGUAGES + 1)
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return rows, {r["lang"]: r["n"] for r in found}


def labelled_sample(docs: DataFrame, text: str = "text", lang: str = "lang", key: Sequence[str] = (),
                    most_rows: int = 20_000) -> tuple[DataFrame, dict[str, int]]:
    """``text, lang`` of at most about ``most_rows`` labelled rows, stored, and the
    rows per language in the whole table.

    Every language has the same part of the bound; of a larger one, the
    rows with the smallest hashes of ``key`` and text are taken, at any size of
    the table. Without a key, copies of a text are all taken or none.
    """
    rows, sizes = labelled(docs, text, lang, key)
    shares = docs.sparkSession.createDataFrame(
        [(k, min(1.0, most_rows / len(sizes) / n)) for k, n in sizes.items()], "lang string, share double")
    chosen = rows.join(F.broadcast(shares), "lang").filter(  # MOST_LANGUAGES rows at most
        F.pmod("place", F.lit(1_000_000)) / 1_000_000.0 < F.col("share"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store(chosen.select("text", "lang").repartition(parts)), sizes


def fit(rows: DataFrame, sizes: dict[str, int], *, most_grams: int = 20_000,
        most_model: int = 2_000_000, ratio: float = 0.2, hashes: int = 4, files: int | None = None) -> Model:
    """Learn the profiles of all languages at once from the ``text, lang`` of ``rows``
    (:func:`labelled` or :func:`labelled_sample`).

    A gram belongs to the languages in which its relative frequency is at least
    ``ratio`` of that in the language where it is most frequent. Each language
    keeps its ``most_grams`` most frequent grams, or an equal part of
    ``most_model`` if there are too many languages for that. They are stored in at
    most ``files`` files.
    """
    if not sizes:
        return Model.build({}, {}, hashes)
    counted = map_texts(rows.select("text", "lang"), "text", "lang string, gram long, n long", _grams_of, _BATCH)
    grams = store(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), files)
    totals = F.broadcast(grams.groupBy("lang").agg(F.sum("n").alias("total")))  # MOST_LANGUAGES rows
    rated = grams.join(totals, "lang").select("gram", "lang", (F.col("n") / F.col("total")).alias("rate"))
    best = rated.groupBy("gram").agg(F.collect_list(F.struct("lang", "rate")).alias("of"))
    held = (best.select("gram", F.array_max(F.col("of.rate")).alias("top"), F.explode("of").alias("of"))
            .filter(F.col("of.rate") >= ratio * F.col("top"))
            .select("gram", "of.lang", "of.rate"))
    most = min(most_grams, most_model // len(sizes))
    first = held  # a slice keeps what its language may keep, so that no task ranks all grams of one
    for group in (["lang", F.pmod("gram", F.lit(_SLICES))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("rate"), "gram"))
        first = first.withColumn("place", place).filter(F.col("place") <= most)
    found = first.select("lang", "gram").toPandas()
    profiles = {k: np.zeros(0, np.uint64) for k in sizes}
    for name, own in found.groupby("lang")["gram"]:
        profiles[name] = own.to_numpy().astype(np.int64).view(np.uint64)
    return Model.build(profiles, sizes, hashes)


def predict(docs: DataFrame, model: Model, text: str = "text",
            names: tuple[str, ...] = ("lang_pred", "lang_score", "lang_evidence")) -> DataFrame:
    """The rows with a predicted language, its score and the evidence for it added,
    as many of them as ``names``.

    NULL or empty text, or one without a letter: ``und`` with score and evidence 0. The
    names of the new columns get underscores where the table has them already.
    """
    new = [free_name(docs, n) for n in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [StringType(), DoubleType(), DoubleType()]
    schema = StructType([*docs.schema.fields, *[StructField(n, k) for n, k in zip(new, kinds)]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores, evidence = shared.value.predict(batch[text].to_pylist())
        added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(evidence, pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *added[:len(new)]],
                                          [*batch.schema.names, *new])

    return map_texts(docs, text, schema, run, _BATCH)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: predictions of a model learned
    from the rows whose ``crc32(id) mod 4`` is not 2.

    * Rows with a NULL id are neither learned from nor held out.
    * NULL or empty text, or one without a letter: ``und`` with score 0; the same for
      all rows if none is labelled.
    * Ties go to the language with more rows, then the smaller name. Repeated rows are
      predicted each; other columns are ignored. No rows: no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).alias("lang"))
    rest: Column = remainder("doc_id", 4)
    model = fit(*labelled_sample(rows.filter(rest != 2), key=["doc_id"]))
    out = predict(rows.select("doc_id", "text"), model, names=("lang_pred", "score"))
    return out.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")


def least_evidence(judged: DataFrame, lang: str, label: str, evidence: str) -> float:
    """Half the evidence that all but the lowest per cent of the labelled texts have."""
    low = judged.filter(F.col(lang).isNotNull() & (F.col(label) != UNKNOWN)).agg(
        F.percentile_approx(evidence, 0.01)).first()[0]
    return 0.5 * (low or 0.0)


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang",
               key: Sequence[str] = ()) -> DataFrame:
    """The documents whose text is in one of the languages of the labelled rows; a
    missing ``lang`` becomes the one found, all else stays as it is.

    A document goes if its text has no letter, or if too few of its grams are
    known in the best language: fewer than half the share that all but the lowest per
    cent of the labelled texts reach (:func:`least_evidence`). Grams, languages and
    that share come from every labelled row, so ``key`` has nothing to choose. All rows
    are judged once and stored.

    * No labelled row: nothing is known of any language, so only texts without a
      letter go. A NULL text has no letter.
    * Rows that repeat each other are judged alike; other columns, whatever their names,
      stay. No rows: no rows.
    """
    files = few_files(docs, text, least=4)
    model = fit(*labelled(docs, text, lang, key), files=files)
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    label, score, evidence = (free_name(docs, n) for n in ("lang_pred", "lang_score", "lang_evidence"))
    judged = store(predict(docs, model, text, (label, score, evidence)), files)
    least = least_evidence(judged, lang, label, evidence)
    found = F.coalesce(F.col(lang), F.col(label).cast(docs.schema[lang].dataType))
    return judged.filter((F.col(label) != UNKNOWN) & (F.col(evidence) >= least)).withColumn(
        lang, found).select(*[f"`{c}`" for c in docs.columns])
