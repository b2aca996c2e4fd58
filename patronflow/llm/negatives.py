"""Operator 13: hard negatives by cover trees over norm-augmented candidates.

Every candidate x gets one more component, sqrt(M^2 - |x|^2) with M the longest
norm of its tree, so that all candidates lie on one sphere and
``|q - x|^2 = |q|^2 + M^2 - 2 q.x`` for every query q: distance bounds bound inner
products. A cover tree halves its covering radius from level to level: a node
covers its members, its children are chosen greedily further apart than half its
radius and cover the members within that half. Distance d to a node's centre and
covering radius r then bound the products of all members by
``(|q|^2 + M^2 - max(0, d -+ r)^2) / 2``.

A search descends best first, by upper bounds. It skips nodes whose bounds lie
outside every wanted window of scores, or below what a window holds already, and
scores the leaves exactly, in whole numbers. Each tree holds a bounded, hash-dealt part
of the candidates, so all of them are searched, tree by tree, and the best of each
tree are merged.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: Numbers (candidates times components) of one tree.
TREE_NUMBERS = 1 << 19
#: Squared norms stay below, so that every product is a whole double.
MOST_NORM = float(1 << 53)
_SLACK = 1e-6
_CHUNK = 128


def whole_vectors(df: DataFrame, vec_id: str, embedding: str, label: str | Column,
                  scale: int = 256) -> DataFrame:
    """``vec_id, label, vector``: each component x becomes floor(scale * x).

    Rows without id, label or vector, with a NULL or non-finite component, or too
    long for whole doubles (:data:`MOST_NORM`) take no part.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     F.transform(embedding, lambda x: x.cast("double")).alias("vector")).dropna()
    fine = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < math.sqrt(MOST_NORM)))
    rows = rows.filter(F.coalesce(fine, F.lit(False))).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double")))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return rows.filter(norm < MOST_NORM).withColumn("vector", F.col("vector").cast("array<int>"))


def _matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(np.asarray(vectors.offsets))
    width = int(sizes.max(initial=0)) if width is None else width
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out[:, :width]


class CoverTree:
    """A cover tree as arrays. Node k has the centre ``vectors[k]`` (whole numbers),
    covering radius ``radius[k]`` (below 0: a leaf, one candidate), its children
    from ``first[k]`` to ``last[k]``, and the label all members share (``mixed``: none).
    Leaf k stands for the rows ``ids[cut[k]:cut[k + 1]]``, ascending."""

    FIELDS = ("vectors", "radius", "first", "last", "label", "mixed", "cut", "ids")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.vectors = self.vectors.astype(np.float64)
        self.longest = float((self.vectors ** 2).sum(1).max(initial=0.0))

    @classmethod
    def build(cls, vectors: np.ndarray, labels: np.ndarray, ids: list[np.ndarray]) -> CoverTree:
        norms = (vectors ** 2).sum(1)
        longest = norms.max(initial=0.0)
        points = np.column_stack([vectors, np.sqrt(longest - norms)])

        def apart(some: np.ndarray, others: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(2 * longest - 2 * (points[some] @ points[others].T), 0.0))

        slack = _SLACK * math.sqrt(longest)
        whole = np.arange(len(vectors))
        centre, radius, first, last, members = [0], [], [], [], [(whole, apart(whole[:1], whole)[0])]
        node = 0
        while node < len(centre):
            own, far = members[node]
            members[node] = own if len(own) == 1 else None
            reach = far.max(initial=0.0)
            first.append(len(centre))
            if len(own) == 1:
                radius.append(-1.0)
            else:
                radius.append(reach + slack)
                if reach <= slack:
                    children = [(k, np.array([k]), np.zeros(1)) for k in own]
                else:
                    near = far <= reach / 2
                    children = [(centre[node], own[near], far[near]),
                                *cls._net(own[~near], reach / 2, apart)]
                for middle, part, gaps in children:
                    centre.append(middle)
                    members.append((part, gaps))
            last.append(len(centre))
            node += 1
        centre, last, first = np.array(centre), np.array(last), np.array(first)
        low, high = labels[centre].copy(), labels[centre].copy()
        for k in range(len(centre) - 1, -1, -1):
            if last[k] > first[k]:
                low[k], high[k] = low[first[k]:last[k]].min(), high[first[k]:last[k]].max()
        leaf = np.array(radius) < 0
        sizes = np.zeros(len(centre), np.int64)
        sizes[leaf] = [len(ids[k]) for k in centre[leaf]]
        return cls(vectors=vectors[centre], radius=np.array(radius), first=first, last=last, label=low,
                   mixed=low != high, cut=np.append(0, np.cumsum(sizes)),
                   ids=np.concatenate([ids[k] for k in centre[leaf]]))

    @staticmethod
    def _net(left: np.ndarray, reach: float, apart) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Centres further than ``reach`` from each other, with the members each covers."""
        while len(left):
            gaps = apart(left[:_CHUNK], left)
            free = np.ones(len(left), bool)
            for k in range(len(gaps)):
                if free[k]:
                    near = free & (gaps[k] <= reach)
                    near[k] = True
                    free &= ~near
                    # the centre comes first: it is its own first child
                    yield left[k], left[near], np.where(left[near] == left[k], 0.0, gaps[k][near])
            left = left[free]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS} | {
            "vectors": self.vectors.astype(np.int32)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        return cls(**np.load(io.BytesIO(data)))

    def search(self, query: np.ndarray, label: int, same: bool, own_id: int, low: np.ndarray,
               high: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The first ``most`` rows, by score and id, of each window of scores
        ``low[w]..high[w]`` among the rows of the ``same`` label or of other ones:
        scores and ids. The row ``own_id`` is left out."""
        base = float(query @ query) + self.longest
        slack = _SLACK * math.sqrt(base)
        floor = low.astype(np.float64)
        found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in low]
        queue = [(-math.inf, 0)] if len(self.radius) else []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor.min():
                break
            if self.radius[node] < 0:           # only the root can be a leaf here
                part = slice(node, node + 1)
            else:
                part = slice(self.first[node], self.last[node])
            scores = self.vectors[part] @ query
            radius = self.radius[part]
            alike = self.label[part] == label
            wanted = (self.mixed[part] | alike) if same else (self.mixed[part] | ~alike)
            leaf = radius < 0
            hits = np.flatnonzero(leaf & wanted & (scores >= floor.min()) & (scores <= high.max()))
            if len(hits):
                for w in range(len(low)):
                    found[w] = self._merge(found[w], part.start + hits, scores[hits], own_id,
                                           floor[w], high[w], most)
                    if len(found[w][0]) == most:
                        floor[w] = max(floor[w], found[w][0][-1])
            inner = np.flatnonzero(~leaf & wanted)
            if len(inner):
                gap = np.sqrt(np.maximum(base - 2 * scores[inner], 0.0))
                upper = (base - np.maximum(gap - radius[inner] - slack, 0.0) ** 2) / 2 + 0.5
                lower = (base - (gap + radius[inner] + slack) ** 2) / 2 - 0.5
                open_ = ((upper[:, None] >= floor) & (lower[:, None] <= high)).any(1)
                for k, u in zip(inner[open_], upper[open_]):
                    heapq.heappush(queue, (-u, part.start + int(k)))
        return found

    def _merge(self, found, leaves, scores, own_id, low, high, most):
        inside = (scores >= low) & (scores <= high)
        leaves, scores = leaves[inside], scores[inside]
        if not len(leaves):
            return found
        if len(scores) > most + 1:
            # a leaf has a row at least, and one may be the query's own
            least = np.partition(scores, len(scores) - most - 1)[len(scores) - most - 1]
            leaves, scores = leaves[scores >= least], scores[scores >= least]
        sizes = self.cut[leaves + 1] - self.cut[leaves]
        at = np.repeat(self.cut[leaves] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        ids, scores = self.ids[at], np.repeat(scores, sizes)
        other = ids != own_id
        ids, scores = np.append(found[1], ids[other]), np.append(found[0], scores[other])
        order = np.lexsort((ids, -scores))[:most]
        return scores[order], ids[order]


def cover_trees(rows: DataFrame, keep: int) -> tuple[DataFrame, int]:
    """``tree, data``: all rows (``vec_id, label, vector``) in cover trees, and their number.

    Rows of one vector and label are one leaf that holds its ``keep`` smallest ids:
    no search for fewer results can reach a later one, as all of them tie. They are
    cut to ``keep`` before the shuffle too, so a vector that a third of all rows share
    is a few rows. Trees are dealt by a hash of vector and label, evenly.
    """
    order = Window.partitionBy("vector", "label").orderBy("vec_id")
    leaves = store(rows.select("vec_id", "label", "vector").distinct()
                   .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= keep)
                   .groupBy("vector", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    size = leaves.agg(F.count("*"), F.max(F.size("vector"))).first()
    trees = max(1, math.ceil(size[0] * max(size[1] or 1, 1) / TREE_NUMBERS))

    def grow(group: pa.Table) -> pa.Table:
        ids = group["ids"].combine_chunks()
        cuts, flat = np.asarray(ids.offsets), np.asarray(ids.values)
        lists = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        tree = CoverTree.build(_matrix(group["vector"]), np.asarray(group["label"]), lists)
        return pa.table({"tree": pa.array([group["tree"][0].as_py()], pa.int32()),
                         "data": pa.array([tree.dump()], pa.binary())})

    dealt = leaves.withColumn("tree", F.pmod(F.xxhash64("vector", "label"), F.lit(trees)).cast("int"))
    return store(dealt.groupBy("tree").applyInArrow(grow, "tree int, data binary")), trees


def search_all(trees: DataFrame, count: int, queries: DataFrame, same: bool, most: int) -> DataFrame:
    """Every query in every tree: ``key, window, vec_id, score``, ``most`` rows at most
    per query, window and tree.

    ``queries`` has ``key, vec_id, label, vector`` and ``windows``, an array of
    (window, low, high). Trees stay where they are dealt; queries stream past them.
    """
    empty = {name: F.lit(None).cast(queries.schema[name].dataType).alias(name) for name in
             ("key", "vec_id", "label", "vector", "windows")}
    held = trees.select("tree", F.lit(0).alias("kind"), "data", *empty.values())
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("tree"), F.lit(1).alias("kind"),
                           F.lit(None).cast("binary").alias("data"), *empty)
    rows = (held.unionByName(asked).repartitionById(count, F.col("tree"))
            .sortWithinPartitions("tree", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, number = None, None
        for batch in batches:
            kinds, numbers = np.asarray(batch["kind"]), np.asarray(batch["tree"])
            at = np.flatnonzero(kinds == 1)
            asked = batch.take(pa.array(at))
            width = None
            vectors = _matrix(asked["vector"])
            windows = asked["windows"].to_pylist()
            ids, labels, keys = (asked[c].to_pylist() for c in ("vec_id", "label", "key"))
            parts: list[tuple] = []
            n = 0
            for k in range(batch.num_rows):
                if kinds[k] == 0:
                    tree, number = CoverTree.load(batch["data"][k].as_py()), numbers[k]
                    continue
                if tree is not None and number == numbers[k] and windows[n]:
                    width = tree.vectors.shape[1]
                    query = vectors[n][:width]
                    if len(query) < width:
                        query = np.append(query, np.zeros(width - len(query)))
                    low = np.array([w["low"] for w in windows[n]], np.float64)
                    high = np.array([w["high"] for w in windows[n]], np.float64)
                    hits = tree.search(query, labels[n], same, ids[n], low, high, most)
                    parts += [(keys[n], w["window"], i, s) for w, (scores, rows) in zip(windows[n], hits)
                              for s, i in zip(scores.astype(np.int64), rows)]
                n += 1
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*parts)],
                                                 ["key", "window", "vec_id", "score"])

    return rows.mapInArrow(run, "key long, window long, vec_id long, score long")


def _windows(*windows: Column) -> Column:
    return F.array(*windows).cast("array<struct<window:bigint,low:bigint,high:bigint>>")


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
         band: tuple[int, int] = (80, 100)) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.

    Both tables have ``vec_id, label, vector`` (see :func:`whole_vectors`). An anchor's
    positives are the first ``positives`` other rows of its label, by inner product and
    then smaller id. Its negatives are the first ``negatives`` rows of other labels with
    ``band[0] * positive_score <= 100 * negative_score <= band[1] * positive_score``.

    * A row is known by id, label and vector: repeated rows count once, and rows that share an
      anchor's id are no other rows. Rows with one id and different content are all kept.
    * Ties: smaller id first, also within a vector that many rows share.
    * A negative positive_score has an empty band, without rows. Vectors of unequal length
      are compared as if the shorter one ended in zeros. Empty tables give no rows.
    """
    trees, count = cover_trees(rows, max(positives, negatives) + 1)
    key = F.xxhash64("vec_id", "label", "vector")
    wide = 1 << 53
    asked = store(anchors.select("vec_id", "label", "vector").distinct().withColumn("key", key).withColumn(
        "windows", _windows(F.struct(F.lit(0), F.lit(-wide), F.lit(wide)))))
    best = Window.partitionBy("key", "window").orderBy(F.desc("score"), "vec_id")

    def first(found: DataFrame, most: int) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)

    near = store(first(search_all(trees, count, asked, True, positives), positives)
                 .groupBy("key").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives")))
    low, high = (F.lit(b).cast("long") * F.col("x") for b in band)
    # whole bounds: rounded up, rounded down
    low, high = (low + F.pmod(-low, F.lit(100))) / 100, (high - F.pmod(high, F.lit(100))) / 100
    scores = (near.select("key", F.explode(F.array_distinct(F.transform("positives", lambda p: p["score"]))).alias("x"))
              .select("key", "x", low.cast("long").alias("low"), high.cast("long").alias("high"))
              .filter("low <= high")
              .groupBy("key").agg(F.collect_list(F.struct(F.col("x").alias("window"), "low", "high")).alias("windows")))
    again = store(asked.drop("windows").join(scores, "key"))
    hard = first(search_all(trees, count, again, False, negatives), negatives)
    pairs = asked.select("key", F.col("vec_id").alias("anchor_id")).join(near, "key").select(
        "key", "anchor_id", F.explode("positives").alias("p")).select(
        "key", "anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("window"))
    return pairs.join(hard, ["key", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        F.col("window").alias("positive_score"), F.col("score").alias("negative_score"))
