"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Documents, and bytes of text, for which a table between the steps has one more file.
FILE_ROWS, FILE_BYTES = 1 << 13, 32 << 20
#: Bits of the filter of :func:`likely`: 64 to a row, so 262,144 broadcast rows at most.
_BITS = 1 << 24


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, files: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, so that a
    lost executor costs a re-read and later steps never recompute this one.
    ``files``: the tasks of the last stage and so the files, at most."""
    spark, schema, path = df.sparkSession, df.schema, shared_folder(df.sparkSession)
    if files is not None:
        df = df.coalesce(files)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def few_files(docs: DataFrame, text: str | Column, least: int = 1) -> int:
    """Files for a table between the steps, in proportion to the documents, at least
    ``least`` for each core. Such a table has a few rows a document at most: with a file
    for each shuffle partition most files would hold a few rows, and Hadoop starts
    processes for each file on a local disk."""
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()
    return files_of(docs.sparkSession, n, size, least)


def files_of(spark: SparkSession, n: int, size: int, least: int = 1) -> int:
    """:func:`few_files` of ``n`` documents with ``size`` bytes of text."""
    return max(least * spark.sparkContext.defaultParallelism, -(-n // FILE_ROWS), -(-size // FILE_BYTES))


def likely(rows: DataFrame, wanted: DataFrame, on: str) -> DataFrame:
    """``rows`` without most of those whose column ``on`` is not in ``wanted``, and with all
    that are: the exact join that follows exchanges fewer rows.

    The filter has a fixed size; the more keys are wanted, the more other rows pass it.
    """
    word, bits = free_name(rows, "word"), free_name(rows, "bits")
    place = F.pmod(F.xxhash64(on), F.lit(_BITS))
    words = wanted.select(place.alias("at")).groupBy(F.floor(F.col("at") / 64).alias(word)).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias(bits))
    near = rows.join(F.broadcast(words), F.floor(place / 64) == F.col(word))
    return near.filter(F.getbit(bits, (place % 64).cast("int")) == 1).drop(word, bits)


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a missing id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % modulus


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not use yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads the low bits of the input."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts, as arrays.

    ``hash`` one 64-bit value per word, ``start``/``end`` its bytes in
    ``data``, ``first`` the index of each text's first word (one entry more
    than there are texts). White space is ASCII here, so the cuts hold on the
    UTF-8 bytes. A missing text has no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
            texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw else \
            np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        if lower:
            data = _LOWER[data]
        inside = ~_SPACE[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.data, self.text_at = data, offsets
        self.first = np.searchsorted(self.start, offsets)
        self.length = self.end - self.start
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Eight bytes a step, so that words of n bytes cost n/8 passes."""
        n = len(self.start)
        out = self.length.astype(np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.lib.stride_tricks.sliding_window_view(padded, 8)
        todo, at = np.arange(n), self.start
        while len(todo):
            left = np.minimum(self.end[todo] - at, 8)
            chunk = np.ascontiguousarray(lanes[at]).view(np.uint64)[:, 0]
            # little endian: the bytes beyond the word are the high ones
            chunk = chunk << (np.uint64(64) - left.astype(np.uint64) * np.uint64(8))
            out[todo] = mix((out[todo] ^ chunk) * _BASE + np.uint64(1))
            more = self.end[todo] - at > 8
            todo, at = todo[more], at[more] + 8
        return out

    def doc(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, k: int) -> str:
        return self.data[self.start[k]:self.end[k]].tobytes().decode()


def batches(texts: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each piece has at most ``most`` bytes of text
    (or one row): memory follows the longest text, not the batch size."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts[column]), 0)
                         .to_numpy(zero_copy_only=False), dtype=np.int64)
    start, size = 0, 0
    for k, n in enumerate(lengths):
        if k > start and size + n > most:
            yield texts.slice(start, k - start)
            start, size = k, 0
        size += n
    if len(lengths) > start:
        yield texts.slice(start)


def map_texts(df: DataFrame, column: str, schema: str,
              f: Callable[[pa.RecordBatch], pa.RecordBatch | None], most: int = 8 << 20) -> DataFrame:
    """Apply ``f`` to Arrow batches of bounded text size."""
    def run(it):
        for batch in it:
            for part in batches(batch, column, most):
                out = f(part)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)
