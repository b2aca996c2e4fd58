"""Operator 1: near-duplicate documents by an LSH forest of MinHash signatures.

Documents with equal shingle sets form one class; only classes are compared.
A class has a signature of :data:`HASHES` minima (16 bits of each are kept).
The forest holds :data:`TREES` orders of that signature. In each order all
classes are sorted by range partitioning, so that classes that agree on a long
prefix become neighbours and dense regions are cut by longer prefixes than
sparse ones. A region is the run of neighbours that share at least
:data:`DEPTH` leading minima, or more where the run would exceed
:data:`REGION` rows: the depth adapts. Within its region a class takes the
next neighbours in order that agree on half of the label. The first
:data:`FIRST` orders come before the others, which then look for links between
different components only: a large group of near copies, which the first orders
have mostly joined, is not paired anew in each order.

Candidates are confirmed on full shingle sets. Where a class had more agreeing
neighbours than it could take, and where a region was cut (by a longer prefix,
a window or a partition border), all classes of the region at :data:`DEPTH` are
searched again, against other components only: once by the whole signature
(:data:`ALIKE` of :data:`HASHES` minima must agree), then by the shingles
themselves (:func:`_rare_pairs`), which needs neither regions nor chance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batches, files_of, free_name, likely, map_texts, mix, store
from .components import components

HASHES, TREES, FIRST, LABEL = 128, 16, 2, 16
DEPTH, REGION = 2, 2048
#: Orders of each round of the forest, and the neighbours a class takes in them.
ROUNDS = ((range(FIRST), 2), (range(FIRST, TREES), 2), (range(TREES), 8))
#: Equal minima that a later round asks for: at similarity 0.8 fewer have a chance of 2e-6.
ALIKE = 80
#: Bytes of text that are cut into shingles at a time: many arrays of eight bytes a word.
_BATCH = 1 << 20
#: Counters of shingles by their low bits; they only set the order of shingles.
COUNTERS = 1 << 18
_WORD2 = np.uint64(0xD1342543DE82EF95)
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(words: Words, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text and where each text begins.

    A text with fewer words than ``width`` has its whole word sequence as the
    one shingle; a text without words has none.
    """
    counts = np.diff(words.first)
    h = words.hash
    parts_hash, parts_doc = [], []
    if len(h) >= width:
        rolled = h[:len(h) - width + 1].copy()
        for k in range(1, width):
            rolled = mix(rolled * _WORD2 + h[k:len(h) - width + 1 + k])
        doc = words.doc()
        whole = doc[:len(rolled)] == doc[width - 1:]
        parts_hash.append(rolled[whole])
        parts_doc.append(doc[:len(rolled)][whole])
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        value = np.uint64(counts[k])
        for x in h[words.first[k]:words.first[k + 1]]:
            value = mix(np.array([value]) * _WORD2 + x)[0]
        parts_hash.append(np.array([value]))
        parts_doc.append(np.array([k]))
    if not parts_hash:
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    value, doc = np.concatenate(parts_hash), np.concatenate(parts_doc)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(len(counts) + 1))


def minima(values: np.ndarray, first: np.ndarray, block: int = 1 << 16) -> list[bytes | None]:
    """16 bits of the minimum of each set under each hash function, in a fixed
    order; None for an empty set. Works on blocks that fit a CPU cache."""
    out: list[bytes | None] = [None] * (len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    at = 0
    while at < len(full):
        end = max(at + 1, int(np.searchsorted(first[full], first[full[at]] + block)))
        part = full[at:end]
        base = first[part[0]]
        own = values[base:first[part[-1] + 1]]
        low = np.empty((len(part), HASHES), dtype=np.uint64)
        for k, seed in enumerate(_SEEDS):
            low[:, k] = np.minimum.reduceat((own ^ seed) * seed, first[part] - base)
        low = (mix(low) >> np.uint64(48)).astype(">u2")
        for k, row in zip(part, low, strict=True):
            out[k] = row.tobytes()
        at = end
    return out


def digests(values: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128-bit digest of each set, None for an empty one."""
    full = np.flatnonzero(np.diff(first))
    out: list[bytes | None] = [None] * (len(first) - 1)
    if len(full):
        sums = np.stack([np.add.reduceat(values, first[full]),
                         np.add.reduceat(mix(values ^ _WORD2), first[full])], axis=1)
        for k, row in zip(full, sums, strict=True):
            out[k] = row.tobytes()
    return out


def describe(docs: DataFrame, text: str, width: int) -> DataFrame:
    """``class, n_shingles, signature`` of every document, after its own columns (``id``
    at least) without the text; the class is a 128-bit digest of the shingle set, NULL
    without words."""
    own = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in own]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, first = shingles(Words(batch[text]), width)
        return pa.RecordBatch.from_arrays(
            [*[batch[n] for n in names], pa.array(digests(values, first), pa.binary()),
             pa.array(np.diff(first), pa.int64()),
             pa.array(minima(values, first), pa.binary())],
            [*names, "class", "n_shingles", "signature"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own)
    return map_texts(docs, text, f"{kinds}class binary, n_shingles long, signature binary", run, _BATCH)


def _labels(classes: DataFrame, *more: str, trees: range = range(TREES)) -> DataFrame:
    """One row per class and tree: its signature in that tree's order."""
    step = 2 * (HASHES // TREES)
    twice = F.concat("signature", "signature")
    return (classes.select("class", "root", *more, F.explode(F.array(*[
        F.struct(F.lit(t).alias("tree"), F.substring(twice, 1 + t * step, 2 * LABEL).alias("label"))
        for t in trees])).alias("_"))
        .select("class", "root", F.col("_.tree").alias("tree"), F.col("_.label").alias("label"), *more))


def nearest_pairs(labels: np.ndarray, roots: np.ndarray, most: int):
    """Candidate pairs among the rows of one region, given in sorted order.

    A row takes the next ``most`` rows of other components that agree with it on at
    least half of the label. If one component holds more than half of the region, only
    the other rows look: for the next rows, and for as many rows of that component
    before them. So the pairs stay in proportion to the rows that are still apart. Also
    returns the rows that had to leave partners out.
    """
    n, half = len(labels), labels.shape[1] // 2
    left, right, full = [], [], []
    names, members = np.unique(roots, return_counts=True)
    main = roots == names[np.argmax(members)]
    large = 2 * main.sum() > n
    look = np.flatnonzero(~main) if large else np.arange(n)
    place = np.arange(n)
    step = max(1, (1 << 21) // max(n, 1))
    for part in (look[k:k + step] for k in range(0, len(look), step)):
        agree = np.zeros((len(part), n), dtype=np.int16)
        for k in range(labels.shape[1]):
            agree += labels[part, k, None] == labels[None, :, k]
        ok = (agree >= half) & (roots[part, None] != roots[None, :])
        ways = [(ok & (part[:, None] < place[None, :]), 1)]
        if large:
            ways.append((ok & (part[:, None] > place[None, :]) & main[None, :], -1))
        for fit, way in ways:
            rank = np.cumsum(fit[:, ::way], axis=1, dtype=np.int32)[:, ::way]
            i, j = np.nonzero(fit & (rank <= most))
            left.append(part[i])
            right.append(j)
            full.append(part[rank.max(axis=1) > most])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left) if left else none, np.concatenate(right) if right else none,
            np.unique(np.concatenate(full)) if full else none)


def region_pairs(labels: np.ndarray, roots: np.ndarray, most: int | None, signatures: np.ndarray,
                 sizes: np.ndarray, percent: int = 80):
    """Like :func:`nearest_pairs` by the whole signatures: partners are of another
    component, agree on half of the label and on :data:`ALIKE` minima, and have a
    set size that allows the similarity (``sizes``, within ``percent``). Only rows outside
    the largest component of the region look for them, which misses no pair of
    components, and take those that agree most.
    """
    n = len(labels)
    left, right, full = [], [], []
    names, members = np.unique(roots, return_counts=True)
    main = names[np.argmax(members)]
    step = max(1, (1 << 21) // max(n, 1))
    for a in range(0, n, step):
        b = min(n, a + step)
        if (roots[a:b] == main).all():
            continue
        agree = np.zeros((b - a, n), dtype=np.int16)
        for k in range(labels.shape[1]):
            agree += labels[a:b, k, None] == labels[None, :, k]
        ok = agree >= labels.shape[1] // 2
        ok &= roots[a:b, None] != roots[None, :]
        for i in np.flatnonzero(ok.any(axis=1) & (roots[a:b] != main)):
            partners = np.flatnonzero(ok[i])
            own, other = sizes[i + a], sizes[partners]
            partners = partners[100 * np.minimum(own, other) >= percent * np.maximum(own, other)]
            alike = (signatures[partners] == signatures[i + a]).sum(axis=1)
            partners, alike = partners[alike >= ALIKE], alike[alike >= ALIKE]
            if most is not None and len(partners) > most:
                partners = partners[np.argsort(-alike, kind="stable")[:most]]
                full.append(np.array([i + a]))
            left.append(np.full(len(partners), i + a))
            right.append(partners)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left) if left else none, np.concatenate(right) if right else none,
            np.concatenate(full) if full else none)


def cut_regions(rows: np.ndarray, depth: int) -> np.ndarray:
    """First row of each run with one prefix of ``depth`` that :func:`regions`
    cuts further, so that not all rows of the run meet."""
    new = np.flatnonzero((rows[1:, :depth] != rows[:-1, :depth]).any(axis=1)) + 1
    bounds = np.concatenate([[0], new, [len(rows)]])
    return bounds[:-1][np.diff(bounds) > REGION]


def regions(rows: np.ndarray, depth: int):
    """Bounds of the regions of sorted rows: the shared prefix is at least
    ``depth`` long, and longer where a region would be too large."""
    if len(rows) < 2:
        return
    cuts = np.flatnonzero((rows[1:, :depth] != rows[:-1, :depth]).any(axis=1)) + 1
    stack = [(0, len(rows), cuts, depth)]
    while stack:
        a, b, cuts, d = stack.pop()
        bounds = np.concatenate([[a], cuts, [b]])
        large = np.flatnonzero(np.diff(bounds) > REGION)
        for k in np.flatnonzero((np.diff(bounds) > 1) & (np.diff(bounds) <= REGION)):
            yield int(bounds[k]), int(bounds[k + 1])
        for k in large:
            x, y = int(bounds[k]), int(bounds[k + 1])
            if d < rows.shape[1]:
                part = rows[x:y, d]
                stack.append((x, y, np.flatnonzero(part[1:] != part[:-1]) + 1 + x, d + 1))
            else:  # the whole label is shared: overlapping windows over the run
                for s in range(x, y - REGION // 2, REGION // 2):
                    yield s, min(s + REGION, y)


def _candidates(labels: DataFrame, most: int, percent: int) -> DataFrame:
    """Candidate pairs ``a < b``. Rows without ``b`` mark what was not searched
    whole: a class ``a`` that had to leave agreeing neighbours out, or a region
    (``tree, prefix``) that was cut; with ``border`` the region begins or ends
    that partition, so it was cut if another partition names it too. Labels with
    signatures are of a later round."""
    later = "signature" in labels.columns
    names = ["a", "b", "tree", "prefix", "border"]

    def marks(tree, label, at, border):
        n = len(at)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
             pa.array([int(tree[k]) for k in at], pa.int32()),
             pa.array([label[k, :DEPTH].astype(">u2").tobytes() for k in at], pa.binary()),
             pa.array([border] * n, pa.int32())], names)

    def run(it):
        kept: list[tuple] = []
        part = TaskContext.get().partitionId()
        last = None

        def flush(final: bool):
            nonlocal kept
            if not kept:
                return
            tree = np.concatenate([k[0] for k in kept])
            label = np.concatenate([k[1] for k in kept])
            key = [x for k in kept for x in k[2]]
            root = np.concatenate([k[3] for k in kept])
            whole = np.concatenate([k[4] for k in kept])
            sizes = np.concatenate([k[5] for k in kept])
            kept = []
            end = len(key)
            cut = []
            if not final:  # the last region may go on in the next batch
                same = (tree == tree[-1]) & (label[:, :DEPTH] == label[-1, :DEPTH]).all(axis=1)
                begin = int(end - np.argmin(same[::-1])) if not same.all() else 0
                if end - begin < 4 * REGION:
                    end = begin
                else:  # a very dense region: half a window goes on
                    begin = end - REGION // 2
                    cut = [begin]
                kept.append((tree[begin:], label[begin:], key[begin:], root[begin:], whole[begin:],
                             sizes[begin:]))
            rows = np.concatenate([tree[:end, None], label[:end]], axis=1)
            cut += cut_regions(rows, 1 + DEPTH).tolist() if end else []
            if cut:
                yield marks(tree, label, cut, None)
            for x, y in regions(rows, 1 + DEPTH):
                i, j, full = (region_pairs(label[x:y], root[x:y], most, whole[x:y], sizes[x:y], percent)
                              if later else nearest_pairs(label[x:y], root[x:y], most))
                n = len(i) + len(full)
                if n:
                    ka = [key[x + k] for k in i] + [key[x + k] for k in full]
                    kb = [key[x + k] for k in j] + [None] * len(full)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ka, pa.binary()), pa.array(kb, pa.binary()), pa.nulls(n, pa.int32()),
                         pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32())], names)

        size = 0
        for batch in it:
            if not batch.num_rows:
                continue
            label = np.frombuffer(b"".join(batch["label"].to_pylist()), dtype=">u2").astype(
                np.uint16).reshape(-1, LABEL)
            whole = np.frombuffer(b"".join(batch["signature"].to_pylist()), dtype=">u2").reshape(
                -1, HASHES) if later else np.zeros((batch.num_rows, 0), np.uint16)
            tree = batch["tree"].to_numpy().astype(np.uint16)
            if last is None:
                yield marks(tree, label, [0], part)
            last = tree, label
            kept.append((tree, label, batch["class"].to_pylist(), batch["root"].to_numpy(), whole,
                         batch["n_shingles"].to_numpy()))
            size += batch.num_rows
            if size >= 8 * REGION:
                yield from flush(False)
                size = len(kept[0][2]) if kept else 0
        if last is not None:
            yield marks(*last, [len(last[0]) - 1], part)
        yield from flush(True)

    parts = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (labels.repartitionByRange(max(parts, TREES), "tree", "label", "class")
                   .sortWithinPartitions("tree", "label", "class"))
    pairs = sorted_rows.mapInArrow(run, "a binary, b binary, tree int, prefix binary, border int")
    paired = F.col("b").isNotNull()
    return pairs.select(F.when(paired, F.least("a", "b")).otherwise(F.col("a")).alias("a"),
                        F.when(paired, F.greatest("a", "b")).alias("b"),
                        "tree", "prefix", "border").distinct()


def _rare_postings(rows: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """``shingle, class, root, size, at`` of the shingles of each class that come
    first, rare ones before frequent ones; ``at`` is the place in that order.

    Of two sets with the similarity, the first shared shingle is among these in
    both. Any order of shingles that is the same for all sets gives that.
    """
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, first = shingles(Words(batch["text"]), width)
        sizes = np.diff(first)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((values, shared.value[(values % np.uint64(COUNTERS)).astype(np.int64)], doc))
        at = np.arange(len(values)) - first[doc]
        early = 100 * (sizes[doc] - at) >= percent * sizes[doc]
        whose = pa.array(doc[early])
        return pa.RecordBatch.from_arrays(
            [pa.array(values[order][early].view(np.int64)), batch["class"].take(whose),
             batch["root"].take(whose), pa.array(sizes[doc][early].astype(np.int64)),
             pa.array(at[early].astype(np.int64))], ["shingle", "class", "root", "size", "at"])

    return map_texts(rows, "text", "shingle long, class binary, root long, size long, at long", run, _BATCH)


def _counters(rows: DataFrame, width: int) -> np.ndarray:
    """How often each counter is met by the shingles of the classes."""
    def run(it):
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in it:
            for part in batches(batch, "text", _BATCH):
                values, _ = shingles(Words(part["text"]), width)
                counts += np.bincount((values % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["counter", "n"])

    found = rows.select("text").mapInArrow(run, "counter long, n long").groupBy("counter").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[found["counter"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _files(rows: DataFrame) -> int:
    """:func:`files_of` the described documents."""
    return files_of(rows.sparkSession, *rows.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first())


def _rare_pairs(active: DataFrame, texts: DataFrame, width: int, percent: int,
                files: int | None = None) -> DataFrame:
    """Pairs ``a < b`` of different components, none with the similarity left out
    but by :data:`ALIKE`.

    Both sets of a pair hold the shingle at which they meet first, and no more
    than what follows it can be shared. So a template in many texts is not
    paired where enough of each text is its own. In the list of a shingle the
    members of its largest component do not look for each other.
    """
    rows = store(texts.join(active.select("class", "root"), "class"), files)
    listed = store(_rare_postings(rows, _counters(rows, width), width, percent), files)
    lists = store(listed.groupBy("shingle", "root").agg(F.count("*").alias("n"))
                  .groupBy("shingle").agg(F.max_by("root", F.struct("n", "root")).alias("main"),
                                          F.count("*").alias("roots"))
                  .filter("roots > 1").select("shingle", "main"), files)
    met = store(likely(listed, lists, "shingle").join(lists, "shingle"), files)
    one = met.filter("root != main").drop("main").alias("x")
    both = one.join(met.drop("main").alias("y"), F.col("x.shingle") == F.col("y.shingle"))
    most = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    # as many files as partitions: these pairs may be far more than the documents
    pairs = store(both.filter(
        (F.col("x.root") != F.col("y.root"))
        & (100 * most >= percent * (F.col("x.size") + F.col("y.size") - most))).select(
        F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct())
    signed = active.select("class", "signature")
    beside = pairs.join(signed.toDF("a", "one"), "a").join(signed.toDF("b", "other"), "b")

    def run(it):
        for batch in it:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), dtype=np.uint16).reshape(-1, HASHES)
                        for c in ("one", "other"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= ALIKE))

    return beside.mapInArrow(run, "a binary, b binary")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("other"))
    both = pairs.join(likely(left, pairs, "a"), "a").join(likely(right, pairs, "b"), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        one, other = batch["text"].dictionary_encode(), batch["other"].dictionary_encode()
        va, fa = shingles(Words(one.dictionary), width)
        vb, fb = shingles(Words(other.dictionary), width)
        keep = []
        for i, j in zip(one.indices.to_pylist(), other.indices.to_pylist(), strict=True):
            x, y = va[fa[i]:fa[i + 1]], vb[fb[j]:fb[j + 1]]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                keep.append(False)
                continue
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_texts(both.select("a", "b", "text", "other"), "text", "a binary, b binary", run, _BATCH)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
                    width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, n_links`` of every document.

    Documents whose sets of distinct ``width``-word shingles (lower-cased A-Z)
    have a Jaccard similarity of at least ``percent`` / 100 are linked;
    ``component_id`` is the smallest id reachable. ``n_links`` counts the links
    of the document's class to other classes that were confirmed on the way
    (at least a spanning set, not all of them).

    * NULL, empty or blank text: empty set, linked with nothing.
    * Fewer words than ``width``: the whole sequence is the one shingle.
    * Equal sets are one class whatever their number; copies are never paired.
    * Rows that repeat an id count as further rows of that document.
    * A NULL id: the row belongs to its class, so it gets the component of an
      equal set that has an id; else ``component_id`` is NULL and it is kept.
    * Other columns are ignored, whatever their names. No rows: no rows.
    """
    return _verdicts(docs, doc_id, text, width, percent).drop("place")


def _verdicts(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """:func:`near_duplicates` with ``place``, a hash of the row's text."""
    named = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("place"),
                        F.col(text).alias("text"))
    rows = store(describe(named.withColumn("bytes", F.octet_length("text").cast("long")), "text", width))
    files = _files(rows)
    filled = rows.filter(F.col("class").isNotNull())
    classes = store(filled.groupBy("class").agg(
        F.min("id").alias("low"), F.first("signature").alias("signature"),
        F.first("n_shingles").alias("n_shingles"),
        F.xxhash64("class").alias("root")), files)
    active, links, checked, roots, texts, seen = classes, None, None, None, None, None
    for turn, (trees, most) in enumerate((*ROUNDS, (None, None))):
        if most is None:  # all that were searched again, whatever their regions
            texts = _with_texts(texts, active.select("class"), named, classes, width, files)
            pairs = _rare_pairs(active, texts, width, percent, files)
        else:
            labels = _labels(active, "n_shingles", *["signature"] * (turn > 1), trees=trees)
            found = store(_candidates(labels, most, percent), files)
            seen = found if seen is None else seen.unionByName(found)
            pairs = found.filter(F.col("b").isNotNull()).select("a", "b")
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = store(pairs, files)
        texts = _with_texts(texts, pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(),
                            named, classes, width, files)
        # links are small rows: an exchange leaves their confirmation in all its tasks
        new = store(_confirm(pairs, texts, width, percent).repartition(files))
        links = new if links is None else links.unionByName(new)
        checked = pairs if checked is None else checked.unionByName(pairs)
        roots = store(components(links, files), files)
        if most is None:
            break
        if turn == 1:  # only regions that were not searched whole are searched again, all of their classes
            crowded = store(_crowded(_labels(classes), seen), files)
            active = store(likely(classes, crowded, "class").join(crowded, "class", "left_semi"), files)
            if not active.limit(1).count():
                break
        active = store(_rooted(active.drop("root"), roots), files)
    members = classes.drop("root").join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "low", F.coalesce("root", "class").alias("root"))
    lowest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    degree = (links.select(F.explode(F.array("a", "b")).alias("class"))
              .groupBy("class").agg(F.count("*").alias("n_links")))
    verdicts = members.join(lowest, "root").join(degree, "class", "left").select(
        "class", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = rows.drop("signature").join(verdicts, "class", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("doc_id"), "place", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _rooted(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Classes with a number for their component."""
    named = roots.select(F.col("node").alias("class"), F.xxhash64("root").alias("found"))
    return classes.join(named, "class", "left").select(
        *classes.columns, F.coalesce("found", F.xxhash64("class")).alias("root"))


def _crowded(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Classes that share a region (same tree and leading minima) with a class
    that left neighbours out, or whose region was cut."""
    dense = found.filter(F.col("a").isNotNull() & F.col("b").isNull()).select(F.col("a").alias("class"))
    marks = found.filter(F.col("prefix").isNotNull()).groupBy("tree", "prefix").agg(
        F.count_distinct("border").alias("parts"), F.count_if(F.col("border").isNull()).alias("cut"))
    placed = labels.select("class", F.struct("tree", F.substring("label", 1, 2 * DEPTH).alias("prefix")).alias("region"))
    regions = likely(placed, dense, "class").join(dense.distinct(), "class", "left_semi").select("region").union(
        marks.filter("parts > 1 OR cut > 0").select(F.struct("tree", "prefix"))).distinct()
    return likely(placed, regions, "region").join(regions, "region", "left_semi").select("class").distinct()


def _with_texts(texts: DataFrame | None, wanted: DataFrame, named: DataFrame, classes: DataFrame,
                width: int, files: int) -> DataFrame:
    """``texts`` and the texts of the ``wanted`` classes that it lacks."""
    if texts is not None:
        wanted = store(wanted.join(texts, "class", "left_anti"), files)
        if not wanted.limit(1).count():
            return texts
    ids = store(classes.join(wanted, "class").select("class", F.col("low").alias("id")), files)
    more = store(_texts_of(likely(named, ids, "id"), ids, width), files)
    return more if texts is None else texts.unionByName(more)


def _texts_of(named: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``class, text``: a text of each class, found again by its smallest id.
    Rows that share an id are told apart by their set, computed anew."""
    rows = named.join(ids, "id").select("text", "class")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, first = shingles(Words(batch["text"]), width)
        same = [x is not None and x == y for x, y in zip(
            digests(values, first), batch["class"].to_pylist(), strict=True)]
        return batch.select(["class", "text"]).filter(pa.array(same, pa.bool_()))

    return map_texts(rows, "text", "class binary, text string", run, _BATCH)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, width: int = 5,
             percent: int = 80) -> DataFrame:
    """The documents without near-duplicates: one of each group stays, with all
    its columns.

    * Rows are told apart by id and text: another text under the id of a
      document that goes is judged on its own.
    * Rows whose id is NULL stay unless a row with an id has the same shingles; rows
      that repeat a kept id with the same text stay together.
    * NULL, empty and blank texts stay. No rows: no rows.
    """
    verdicts = _verdicts(docs, doc_id, text, width, percent)
    id_, place = free_name(docs, "near_id"), free_name(docs, "near_place")
    gone = verdicts.filter(~F.col("kept")).select(
        F.col("doc_id").alias(id_), F.col("place").alias(place)).distinct()
    return docs.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col(id_))
                     & (F.xxhash64(text) == F.col(place)), "left_anti")
