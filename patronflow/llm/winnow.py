"""Operator 6: document fingerprints by winnowing, in built-in functions only.

A text is a sequence of units: its words, but single characters in scripts that
are written without blanks and in words longer than :data:`LONG_WORD`. A unit depends on
its own word alone, so a shared stretch has the same units whatever surrounds it.
Every run of :data:`K` units has a hash, rolled along the units (cyclic polynomial: the
hash of each unit, rotated by its place, all combined by exclusive or); every window of :data:`W` such hashes gives its minimum, the rightmost if
several are equal. The fingerprint is the set of those minima with their
positions, so two texts that share :data:`W` + :data:`K` - 1 units in a row share
at least one minimum.

Hash and position are packed into one number, hash above position counted
backwards: a plain minimum is then the rightmost smallest hash. Every step is
one pass over an array, linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name

K, W = 3, 4
LONG_WORD = 32
_POSITION_BITS = 31
_LAST = (1 << _POSITION_BITS) - 1
_BLANKS = " \t\n\x0b\x0c\r"
# Code points of scripts without blanks between words (Thai and Lao,
# Myanmar, Khmer, kana, ideographs). Ranges, as asking for a character's script is slow.
_SPACELESS = (r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}"
              r"\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}")
_PART = rf"[^\x20\x09-\x0D{_SPACELESS}]"
#: A whole word of at most LONG_WORD characters, else one character.
UNIT = rf"(?<!{_PART}){_PART}{{1,{LONG_WORD}}}(?!{_PART})|{_PART}|[{_SPACELESS}]"
_CUT = rf"[{_SPACELESS}]|(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{{LONG_WORD + 1}}}"


def _at(name: str, index: Column, step: int) -> Column:
    return F.get(F.col(f"`{name}`"), index + F.lit(step))


def _rotated(x: Column, by: int) -> Column:
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by)) if by else x


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the selected (hash, position) numbers in text order; empty
    for a NULL or blank text. Fewer than K units are one gram, fewer than W
    grams one window. Texts of any length are handled whole, in linear time."""
    own = [f"`{c}`" for c in df.columns]
    trimmed = F.btrim(F.col(text), F.lit(_BLANKS))
    words = F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    hashes, grams, mins = (free_name(df, f"_{out}_{n}") for n in ("hashes", "grams", "mins"))
    # Where no word is cut, the words are the units, and splitting is cheaper.
    units = F.when(F.col(text).rlike(_CUT), F.regexp_extract_all(F.col(text), F.lit(UNIT), F.lit(0))).when(
        trimmed != "", words).otherwise(F.array().cast("array<string>"))
    df = df.select(*own, F.transform(units, lambda x: F.xxhash64(x)).alias(hashes))

    def rolled(x: Column, i: Column) -> Column:
        out = _rotated(x, K - 1)
        for k in range(1, K):
            out = out.bitwiseXOR(_rotated(F.coalesce(_at(hashes, i, k), F.lit(0)), K - 1 - k))
        return out.bitwiseAND(F.lit(-1 << _POSITION_BITS)).bitwiseOR(F.lit(_LAST) - i)

    df = df.select(*own, F.slice(F.transform(hashes, rolled), 1, F.greatest(
        F.size(hashes) - (K - 1), F.lit(1))).alias(grams))
    df = df.select(*own, F.slice(F.transform(grams, lambda x, i: F.least(
        x, *[_at(grams, i, k) for k in range(1, W)])), 1,
        F.greatest(F.size(grams) - (W - 1), F.lit(1))).alias(mins))
    return df.select(*own, F.array_distinct(mins).alias(out))


def hashes_of(fingerprint: str | Column) -> Column:
    """The distinct hashes of a fingerprint, without positions."""
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, _POSITION_BITS)))


def positions_of(fingerprint: str | Column) -> Column:
    """Index of the first unit of each selected gram."""
    return F.transform(fingerprint, lambda x: F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST)))


def as_text(fingerprint: str | Column) -> Column:
    """A digest of hashes and positions; empty for an empty fingerprint."""
    return F.when(F.size(fingerprint) == 0, "").otherwise(
        F.sha2(F.array_join(F.transform(fingerprint, lambda x: x.cast("string")), " "), 256))


def likeness(one: str, other: str) -> Column:
    """Shared part of two sets of distinct hashes; 1 for two empty ones."""
    shared = F.size(F.array_intersect(one, other))
    all_ = F.size(one) + F.size(other) - shared
    return F.when(all_ == 0, 1.0).otherwise(shared / F.greatest(all_, F.lit(1)))


def _dealt(docs: DataFrame) -> DataFrame:
    """Deal ``id, text`` into ranges of ids, each with a copy of the row that
    follows its last one: ``part, ahead, id, text``.

    The cuts are ids of the table (quantiles of the id column alone, as many as
    there are shuffle partitions, whatever the data), so that the first row of
    each range is known beforehand.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(
        F.min("id").alias("low"), F.max(F.col("id").isNull()).alias("missing"),
        F.percentile_approx("id", [k / parts for k in range(1, parts)], 10_000).alias("cuts")
        if parts > 1 else F.lit(None).cast("array<bigint>").alias("cuts")).first()
    cuts = sorted({c for c in found["cuts"] or [] if c > found["low"]})
    ids = F.col("id")
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(bounds, lambda c: c <= ids)), F.lit(0))
    part = F.when(ids.isNull(), 0).otherwise(part)
    first = ids.isNull() if found["missing"] else ids == F.lit(found["low"])
    place = lambda p, ahead: F.struct(p.cast("int").alias("part"), F.lit(ahead).alias("ahead"))
    places = F.array(place(F.col("_p"), 0), F.when(F.col("_cut"), place(F.col("_p") - 1, 1)),
                     F.when(F.col("_first"), place(F.lit(len(cuts)), 1)))
    marked = docs.select("id", "text", part.alias("_p"),
                         F.coalesce(F.array_contains(bounds, ids), F.lit(False)).alias("_cut"),
                         F.coalesce(first, F.lit(False)).alias("_first"))
    return (marked.select("id", "text", F.explode(F.filter(places, lambda x: x.isNotNull())).alias("at"))
            .select("at.part", "at.ahead", "id", "text"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited text has its last quarter (rounded down, in code points) replaced
    by the first as many of the next document by id; the first follows the
    last. Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_selected``.

    * NULL text: empty. Two empty texts are alike (1), an empty and another not (0).
    * Rows with one id follow each other by text; NULL ids come first.
    * A single document is its own successor. Other columns are ignored.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = _dealt(rows).repartition(parts, "part")
    own = with_fingerprint(dealt, "text", "print").withColumn("hashes", hashes_of("print"))
    following = Window.partitionBy("part").orderBy("ahead", F.asc_nulls_first("id"), "text")
    paired = own.withColumn("next_text", F.lead("text").over(following)).withColumn(
        "next_hashes", F.lead("hashes").over(following)).filter("ahead = 0")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut),
                      F.substring(F.col("next_text"), F.lit(1), cut))
    out = paired.select("id", n.cast("long").alias("n_chars"), "print", "hashes",
                        edited.alias("edited"), likeness("hashes", "next_hashes").alias("near_next"))
    out = with_fingerprint(out, "edited", "edited_print").withColumn(
        "edited_hashes", hashes_of("edited_print"))
    return out.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text("print").alias("fingerprint"), as_text("edited_print").alias("edited_fingerprint"),
        likeness("hashes", "edited_hashes").alias("near_edited"), "near_next",
        F.size("print").cast("long").alias("n_selected"))
