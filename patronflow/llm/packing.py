"""Operator 7: pack token sequences into windows by best-fit decreasing.

Overlong documents are first cut into full windows; the rest of each document is
one piece. Best-fit decreasing takes pieces in falling length and puts each into
the tightest open window that has room. Pieces of one length are alike, so the
packing follows from the counts per length alone: a table of at most ``size``
rows, whatever the corpus. The driver packs those counts, moving whole runs of
windows at once, and finds the tightest open capacity with a segment tree. The
outcome is a plan of runs (length, first rank, first window, stack, offset),
which the executors apply to the ranked pieces. No piece passes through the
driver, and no task holds more than a part of one length.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, store

WINDOW = 4096
END = 2
CHUNKS = 256
CACHE_WORDS = 1 << 20


class CapacityTree:
    """Segment tree over capacities 0..size: is a window of that capacity open?
    ``tightest(n)`` is the smallest open capacity of at least ``n``."""

    def __init__(self, size: int):
        self.leaves = 1 << max(1, size).bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.leaves
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = least + self.leaves
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(counts: dict[int, int], size: int = WINDOW) -> list[tuple[int, ...]]:
    """Best-fit decreasing over counts per length.

    Rows ``(length, first rank, first window, pieces a window, offset)``: from
    that rank on, the pieces of that length fill consecutive windows with so
    many pieces each, from that offset on.
    """
    tree, runs = CapacityTree(size), [deque() for _ in range(size + 1)]
    out, windows = [], 0

    def add(room: int, first: int, count: int) -> None:
        if room and count:
            runs[room].appendleft((first, count))
            tree.mark(room, True)

    for length in sorted((n for n, c in counts.items() if c and n > 0), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = size
                add(size, windows, -(-left // (size // length)))
                windows += -(-left // (size // length))
            first, count = runs[room].popleft()
            if not runs[room]:
                tree.mark(room, False)
            # after one piece the same window is the tightest while it has room
            each = min(room // length, left)
            used = min(count, left // each)
            out.append((length, rank, first, each, size - room))
            add(room, first + used, count - used)
            add(room - each * length, first, used)
            rank, left = rank + used * each, left - used * each
    return out


class WordTokens:
    """Ids of a text whose tokenizer drops white space between words.

    Words between blanks do not influence each other there, so each distinct
    word is tokenized once (a bounded cache of id bytes). Texts are lower-cased
    first, as the tokenizer does, so that there are fewer. Words of letters alone
    are one pre-token each and are tokenized many at a time; their ends show in
    the ids. A tail of punctuation is a pre-token of its own, but for letters that
    become a letter and a mark when composed or lower-cased: the mark joins the tail.
    """

    TAIL = ".,;:!?|*#$%&"
    #: The letter that lower case turns into a letter and a mark.
    DOTTED = "\u0130"
    TOGETHER = 500

    def __init__(self, path: str):
        # A task has one core; the worker process is this task's own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if w.isalpha()]
        odd = [w for w in new if not w.isalpha()]
        parts = [plain[at:at + self.TOGETHER] for at in range(0, len(plain), self.TOGETHER)]
        found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, encoded in zip(parts, found, strict=True):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):  # letters that the tokenizer cuts or drops
                odd += part
                continue
            data, begin = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist(), strict=True):
                self.known[word] = data[4 * begin:4 * end]
                begin = end
        for word, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False),
                           strict=True):
            self.known[word] = np.array(e.ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        known = self.known
        if len(known) + 2 * len(words) > CACHE_WORDS:
            known.clear()
            known[""] = b""
        stems: dict[str, str] = {}
        parts: set[str] = set()
        for word in words:
            if word in known:
                continue
            if word[-1:] not in self.TAIL:  # the empty word is known
                parts.add(word)
                continue
            stem = word.rstrip(self.TAIL)
            if stem.isascii() and stem.isalpha() or \
                    unicodedata.normalize("NFC", stem).lower().isalpha():
                stems[word] = stem
                parts.update((stem, word[len(stem):]))
            else:
                parts.add(word)
        self._learn([w for w in parts if w not in known])
        for word, stem in stems.items():
            known[word] = known[stem] + known[word[len(stem):]]

    def lower(self, text: str) -> str:
        """The text in lower case, if the tokenizer sees no difference; else itself.

        It looks for special tokens first, then composes marks, then lowers the
        letters one by one, so letters that compose once they are lowered stay as they are.
        """
        if self.DOTTED in text or "<|" in text or not unicodedata.is_normalized("NFC", text):
            return text
        # A capital sigma has one lower-case form to the tokenizer, wherever it stands.
        low = text.replace("\u03a3", "\u03c3").lower()
        return low if unicodedata.is_normalized("NFC", low) else text

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.lower(t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                 for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        self.learn(new)
        known = self.known
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4") for words in split]


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """Kept by the worker process between tasks."""
    return WordTokens(path)


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
           size: int = WINDOW, ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every piece, with the
    token ids themselves (``ids``) on demand.

    A document is its tokens and then id :data:`END`; a NULL text has only that
    one. Cuts fall at multiples of ``size``.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, length long, "
              "ids_crc32 long, doc_tokens long" + (", ids array<int>" if ids else ""))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = word_tokens(path)
        row, start, length, crc, total, parts = [], [], [], [], [], []
        for k, own in enumerate(tokens.batch(batch["text"].to_pylist())):
            own = np.append(own, np.uint32(END)).astype("<u4")
            for at in range(0, len(own), size):
                part = own[at:at + size]
                row.append(k)
                start.append(at)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
                total.append(len(own))
                if ids:
                    parts.append(part.astype(np.int32))
        columns = [batch["doc_id"].take(pa.array(row, pa.int64()))] + [
            pa.array(x, pa.int64()) for x in (start, length, crc, total)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if ids:
            columns.append(pa.array(parts, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return map_texts(rows, "text", schema, run)


def _place(runs: list[tuple[int, ...]]) -> dict[str, np.ndarray]:
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 48) + table[:, 1], "rank": table[:, 1],
            "window": table[:, 2], "each": table[:, 3], "offset": table[:, 4]}


def pack(found: DataFrame, size: int = WINDOW) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` added.

    ``found`` has ``doc_id``, ``start`` and ``length`` (1 to ``size``) and may
    have more columns. It should be stored, as it is read twice. Pieces of one
    length are ranked in two steps: inside :data:`CHUNKS` parts by a hash of
    the id, then the parts by their counts, so a frequent length is never in
    one task. Rows that repeat a piece are pieces of their own.
    """
    part = F.pmod(F.xxhash64("doc_id", "start"), F.lit(CHUNKS))
    marked = found.withColumn("_part", part)
    chunk_counts = marked.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = store(chunk_counts.select("length", "_part", "_n", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before")))
    counts = {r["length"]: r["n"] for r in before.groupBy("length").agg(
        F.sum("_n").alias("n")).collect()}  # at most ``size`` rows
    shared = found.sparkSession.sparkContext.broadcast(_place(plan(counts, size)))
    own = Window.partitionBy("length", "_part").orderBy("doc_id", "start")
    ranked = (marked.join(before.drop("_n"), ["length", "_part"])
              .withColumn("_rank", F.row_number().over(own) - 1 + F.col("_before"))
              .drop("_part", "_before"))
    columns = [c for c in ranked.columns if c != "_rank"]

    def run(it):
        place = shared.value
        for batch in it:
            length, rank = (batch[c].to_numpy().astype(np.int64) for c in ("length", "_rank"))
            at = np.searchsorted(place["key"], (length << 48) + rank, side="right") - 1
            step, deep = np.divmod(rank - place["rank"][at], place["each"][at])
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in columns], pa.array(place["window"][at] + step),
                 pa.array(place["offset"][at] + deep * length)],
                [*columns, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema
                       if f.name != "_rank")
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame, size: int = WINDOW, pad: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of packed pieces that carry their ids. A
    sequence is padded to ``size`` unless its tokens are a power of two."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.flatten(ordered["ids"]).alias("ids"))
    exact = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return joined.select("sequence_id", "n_tokens", F.when(exact, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad), (F.lit(size) - F.col("n_tokens")).cast("int")))
    ).alias("ids"))


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                   size: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of
    every piece.

    NULL and empty texts are one token; a NULL id packs like any other; copies
    and repeated rows are packed each; other columns are ignored. No rows: no
    rows.
    """
    return pack(store(pieces(docs, path, doc_id, text, size)), size).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
