"""Operator 9: mix sources to target weights by hierarchical budgets.

The leaves of a tree (domain, language, source) share a token budget. Each node
deals its budget to its children by weight; a child that has too few tokens
takes what it has and its shortage goes to its siblings, and only what a whole
family cannot use reaches the families beside it. A leaf then reads seeded
epochs: whole ones while its budget lasts, and of the next one a prefix, in the
order of a hash of seed, epoch and document.

The prefix ends at a hash value, which is found from token sums of 4096 hash
ranges per leaf and a ranking inside the one range where the budget ends. So no
leaf is sorted as a whole, texts are never shuffled, and a leaf with a third of
all rows costs no more than its share of a scan.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, store

#: A tree with more leaves is refused: it is held by the driver.
MOST_LEAVES = 100_000
_RANGE_BITS = 12

Path = tuple
Weight = Callable[[Path], float]


def word_count(text: str | Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for NULL."""
    blanks = F.lit(" \t\n\x0b\x0c\r")
    trimmed = F.btrim(F.col(text) if isinstance(text, str) else text, blanks)
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(
        F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def share_out(amount: int, parts: list[tuple[object, Fraction, int]]) -> dict:
    """Deal ``amount`` to ``(name, weight, most)`` by weight: whole numbers,
    none above its ``most``; what one cannot take goes to the others by their
    weights. Remainders go by largest fraction, then in the given order."""
    given = {name: 0 for name, _, _ in parts}
    open_ = [(name, w, most) for name, w, most in parts if most > 0 and w > 0]
    # where all weights are used up, the rest goes to those with weight 0
    rest = [(name, Fraction(1), most) for name, w, most in parts if most > 0 and w <= 0]
    left = min(amount, sum(most for _, _, most in parts))
    while left and (open_ or rest):
        if not open_:
            open_, rest = rest, []
        total = sum(w for _, w, _ in open_)
        full = [(n, w, most) for n, w, most in open_ if w * left >= most * total]
        if full:
            for name, _, most in full:
                given[name] = most
                left -= most
            open_ = [x for x in open_ if x not in full]
            continue
        exact = [(name, w * left / total) for name, w, _ in open_]
        for name, x in exact:
            given[name] = int(x)
        short = left - sum(int(x) for _, x in exact)
        for name, x in sorted(exact, key=lambda p: int(p[1]) - p[1])[:short]:
            given[name] += 1
        left = 0
    return given


def budgets(capacity: dict[Path, int], amount: int, weight: Weight) -> dict[Path, int]:
    """The budget of every leaf; ``capacity`` has the tokens a leaf can give."""
    out: dict[Path, int] = {}

    def deal(prefix: Path, leaves: dict[Path, int], own: int) -> None:
        depth = len(prefix)
        families: dict[Path, dict[Path, int]] = {}
        for path, most in leaves.items():
            families.setdefault(path[:depth + 1], {})[path] = most
        order = sorted(families, key=repr)
        part = share_out(own, [(p, Fraction(weight(p)).limit_denominator(10 ** 9),
                                sum(families[p].values())) for p in order])
        for p in order:
            if p in families[p]:
                out[p] = part[p]
            else:
                deal(p, families[p], part[p])

    if capacity:
        deal((), capacity, amount)
    return out


def _key(seed: int, epoch: Column, doc_id: str, text: str) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("long"), F.col(doc_id), F.col(text))


def plan(docs: DataFrame, levels: list[str], weight: Weight, amount: int | float, *,
         doc_id: str = "doc_id", text: str = "text", tokens: Column | None = None,
         seed: int = 0, epochs: int = 1) -> DataFrame:
    """``levels..., leaf_tokens, budget, whole, last``: per leaf the whole epochs
    and the last hash of the epoch after them (NULL: nothing of it).

    ``amount`` is a number of tokens, or as a float a share of all tokens.
    """
    spark = docs.sparkSession
    count = word_count(text) if tokens is None else tokens
    rows = store(docs.select(*[F.col(c).cast("string").alias(f"l{k}") for k, c in enumerate(levels)],
                             F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"),
                             F.coalesce(count, F.lit(0)).cast("long").alias("tokens")))
    names = [f"l{k}" for k in range(len(levels))]
    sums = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")).limit(MOST_LEAVES + 1).collect()
    if len(sums) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves")
    own = {tuple(r[n] for n in names): int(r["tokens"]) for r in sums}
    goal = int(amount * sum(own.values())) if isinstance(amount, float) else amount
    given = budgets({p: n * epochs for p, n in own.items()}, goal, weight)
    leaves = [(*p, own[p], b, b // own[p] if own[p] else 0, b % own[p] if own[p] else 0)
              for p, b in given.items()]
    schema = ", ".join(f"{n} string" for n in names) + ", leaf_tokens long, budget long, whole long, part long"
    tree = spark.createDataFrame(leaves, schema)
    same = [rows[n].eqNullSafe(F.col(f"t.{n}")) for n in names]
    keyed = rows.join(F.broadcast(tree.filter("part > 0")).alias("t"), same).select(
        *[rows[n] for n in names], "part", "tokens",
        F.xxhash64(F.lit(seed), F.col("whole"), "id", "text").alias("key"))
    # signed order: the upper bits of the hash are the range
    ranged = keyed.withColumn("range", F.shiftright("key", 64 - _RANGE_BITS))
    sums = ranged.groupBy(*names, "part", "range").agg(F.sum("tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*names).orderBy("range"))
    ends = sums.withColumn("before", upto - F.col("n")).filter(
        (F.col("before") < F.col("part")) & (F.col("before") + F.col("n") >= F.col("part")))
    ends = ends.select(*[F.col(n).alias(f"e{n}") for n in names], F.col("range").alias("erange"), "before")
    at_end = ranged.join(F.broadcast(ends), [
        *[F.col(n).eqNullSafe(F.col(f"e{n}")) for n in names], F.col("range") == F.col("erange")])
    one = at_end.groupBy(*names, "part", "before", "key").agg(F.sum("tokens").alias("n"))
    reach = F.col("before") + F.sum("n").over(
        Window.partitionBy(*names).orderBy("key")) - F.col("n")
    last = one.withColumn("reach", reach).filter(F.col("reach") < F.col("part")).groupBy(*names).agg(
        F.max("key").alias("last"))
    last = last.select(*[F.col(n).alias(f"e{n}") for n in names], "last")
    out = tree.join(last, [F.col(n).eqNullSafe(F.col(f"e{n}")) for n in names], "left")
    return store(out.select(*[F.col(n).alias(c) for n, c in zip(names, levels, strict=True)],
                            "leaf_tokens", "budget", "whole", "last"))


def mix(docs: DataFrame, levels: list[str], weight: Weight, amount: int | float, *,
        doc_id: str = "doc_id", text: str = "text", tokens: Column | None = None,
        seed: int = 0, epochs: int = 1) -> DataFrame:
    """The chosen documents with all their columns and ``epoch`` (from 0), once
    per epoch that takes them.

    * A prefix holds the documents before which less than the budget is used,
      so its last document may go beyond it.
    * Rows with equal id and text are taken or left together.
    * NULL in a level is a value of its own. NULL text has no tokens; a leaf
      without tokens has no budget and gives nothing.
    * No rows: no rows. ``epoch`` gets underscores if the table has that name.
    """
    tree = plan(docs, levels, weight, amount, doc_id=doc_id, text=text, tokens=tokens, seed=seed,
                epochs=epochs)
    inner = tree.select(*[F.col(c).alias(f"_leaf{k}") for k, c in enumerate(levels)],
                        F.col("whole").alias("_whole"), F.col("last").alias("_last"))
    epoch = free_name(docs, "epoch")
    joined = docs.withColumn("_text", F.xxhash64(text)).join(
        F.broadcast(inner),  # at most MOST_LEAVES rows
        [F.col(c).cast("string").eqNullSafe(F.col(f"_leaf{k}")) for k, c in enumerate(levels)])
    more = F.coalesce(_key(seed, F.col("_whole"), doc_id, "_text") <= F.col("_last"), F.lit(False))
    count = F.col("_whole") + more.cast("long")
    taken = joined.filter(count > 0).withColumn(epoch, F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], epoch)
