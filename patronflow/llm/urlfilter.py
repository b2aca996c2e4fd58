"""Operator 11: URL rules by a cascade of Bloom filters, in built-in functions only.

A rule names a host and the start of a path; it fits that host and all its
subdomains. Each url has one key per *shape* of the rules (number of host
labels, length of the path), so the keys that a url could match are known
without looking at the rules themselves. Membership of a key among the rules is
decided by a cascade: level 1 is a Bloom filter of the listed keys, level 2 one of
those other keys of the corpus that level 1 lets through, level 3 one of the
listed keys that level 2 lets through, and so on until nothing is let through
wrongly. Over the keys of the corpus the cascade is exact, and the urls are
judged in one scan without a join or a shuffle.

What is gathered follows the list, not the corpus: level 1 is sized so that it
lets through about as many other keys as there are rules, whatever the number
of urls. The filters become literals of the plan; a list of more than
:data:`MOST_RULES` keys is refused.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

#: Bound of the list: about 30 bits a key at a million other keys a rule.
MOST_RULES = 1_000_000
#: Bound of the distinct (labels, path length) pairs of a list.
MOST_SHAPES = 2_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path from there up to ``?``, ``#`` or the end. Both empty for
    NULL or without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    whole = "^([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(rest, whole, 1), _UPPER, _LOWER),
            F.regexp_extract(rest, whole, 2))


@dataclass(frozen=True)
class Level:
    """One Bloom filter; ``seed`` makes its hashes independent of other levels'."""

    seed: int
    bits: int
    hashes: int
    words: Column | None = None

    def positions(self, key: Column) -> list[Column]:
        h = F.xxhash64(F.lit(self.seed), key)
        start = F.pmod(h, F.lit(self.bits))
        step = F.shiftrightunsigned(h, 32) % self.bits
        return [(start + step * j) % self.bits for j in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        out = F.lit(True)
        for at in self.positions(key):
            word = F.get(self.words, F.shiftright(at, 6).cast("int"))
            out = out & (F.call_function("bit_get", word, (at % 64).cast("int")) == 1)
        return out


def _level(keys: DataFrame, count: int, seed: int, hashes: int) -> Level:
    """The filter of ``count`` keys; the words are aggregated in the cluster and
    arrive as one number per 64 bits."""
    bits = 64 * max(1, math.ceil(count * hashes / math.log(2) / 64))
    level = Level(seed, bits, hashes)
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    found = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    words = ["0"] * (bits // 64)
    for row in found.toLocalIterator():
        words[row["word"]] = str(row["bits"])
    literal = F.split(F.lit(",".join(words)), ",").cast("array<bigint>")
    return Level(seed, bits, hashes, literal)


@dataclass(frozen=True)
class Cascade:
    """Exact membership over the keys it was built for."""

    levels: tuple[Level, ...]

    def member(self, key: Column) -> Column:
        """The first level that lacks the key decides: an even one says listed,
        an odd one not; a key that all levels hold belongs to the last one's side."""
        out = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels), 0, -1):
            out = F.when(~self.levels[n - 1].holds(key), n % 2 == 0).otherwise(out)
        return out


def build_cascade(listed: DataFrame, others: DataFrame, universe: int | None = None) -> Cascade:
    """The cascade that tells ``listed`` keys from all ``others`` (each a table
    with a column ``key``; an ``others`` key that is listed counts as listed).

    ``universe`` is the rough number of distinct others and only sizes level 1.
    Repeated and NULL keys count once and not at all. ``others`` is read once,
    after that only the keys that were let through wrongly, which are stored.
    """
    inside = store(listed.select("key").dropna().distinct())
    count = inside.count()
    if count > MOST_RULES:
        raise ValueError(f"{count} listed keys; at most {MOST_RULES} fit into one cascade")
    if not count:
        return Cascade(())
    if universe is None:
        universe = others.agg(F.approx_count_distinct("key")).first()[0]
    first = _level(inside, count, 1, max(1, math.ceil(math.log2(max(universe, 1) * math.sqrt(2) / count))))
    levels = [first]
    wrong = store(others.select("key").filter(F.col("key").isNotNull() & first.holds(F.col("key")))
                  .distinct().join(inside, "key", "left_anti"))
    right = inside
    while left := wrong.count():
        levels.append(_level(wrong, left, len(levels) + 1, 1))
        wrong, right = store(right.filter(levels[-1].holds(F.col("key")))), wrong
    return Cascade(tuple(levels))


def _shapes(rules: DataFrame) -> Column | None:
    found = rules.select(F.size(F.split("host", "\\.")).alias("labels"),
                         F.length("path").alias("cut")).distinct().take(MOST_SHAPES + 1)
    if len(found) > MOST_SHAPES:
        raise ValueError(f"the rules have more than {MOST_SHAPES} shapes (host labels, path length)")
    if not found:
        return None
    text = ",".join(f"{r['labels']} {r['cut']}" for r in sorted(found))
    return F.transform(F.split(F.lit(text), ","), lambda s: F.struct(
        F.split(s, " ")[0].cast("int").alias("labels"), F.split(s, " ")[1].cast("int").alias("cut")))


def keys_of(host: Column, path: Column, shapes: Column) -> Column:
    """The keys of a url, one per shape that it is long enough for."""
    labels = F.split(host, "\\.")
    return F.filter(F.transform(shapes, lambda s: F.when(
        (F.size(labels) >= s["labels"]) & (F.length(path) >= s["cut"]),
        F.concat(F.array_join(F.slice(labels, -s["labels"], s["labels"]), "."),
                 F.substring(path, F.lit(1), s["cut"])))), lambda k: k.isNotNull())


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          default: str = "allow") -> DataFrame:
    """Verdict of the longest rule that fits each url: ``page_id, host, path, rule,
    verdict``.

    ``rules`` has ``host, path, verdict`` (allow or block). A rule fits its host
    and all subdomains if the url's path starts with the rule's path. Without a
    rule ``rule`` is NULL and the verdict ``default``: the cascade has shown that
    no key of the url is listed.

    * Of rules of equal length the one with the longer host wins; a key that is
      both allowed and blocked is blocked. Repeated rules count once.
    * Rules with a NULL, or with an empty host, take no part; another verdict is
      an error. No rules: everything gets ``default``.
    * NULL, empty and odd urls have an empty host and path and fit no rule;
      repeated pages give repeated rows; other columns are ignored.
    """
    rules = store(rules.select(
        F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
        .filter("host <> ''").select("host", "path", "verdict", F.concat("host", "path").alias("key")))
    odd = rules.filter(~F.col("verdict").isin("allow", "block")).take(1)
    if odd:
        raise ValueError(f"unknown verdict: {odd[0]['verdict']}")
    host, path = host_and_path(url)
    urls = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    shapes = _shapes(rules)
    if shapes is None:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = keys_of(F.col("host"), F.col("path"), shapes)
    listed = build_cascade(rules, urls.select(F.explode(keys).alias("key")))
    blocked = build_cascade(rules.filter("verdict = 'block'"), rules)
    fits = F.transform(F.filter(keys, listed.member), lambda k: F.struct(
        F.length(k).alias("n"), F.length(F.substring_index(k, "/", 1)).alias("host"), k.alias("key")))
    found = urls.select("*", F.array_max(fits)["key"].alias("rule"))
    return found.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull(), default)
                        .when(blocked.member(F.col("rule")), "block").otherwise("allow").alias("verdict"))
