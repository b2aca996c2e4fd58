"""Operator 4: language model scores from Brown classes.

The probability of a token is that of its class after the class of the token before
it, times that of the token within its class. Exchange clustering assigns words to
classes: a word moves to the class that raises the likelihood most. It runs twice.

* First over a bounded table of units, one move at a time and until nothing moves: the
  end mark, the :data:`FREQUENT` most frequent words, and for all other words their last
  two bytes (the most frequent :data:`ENDINGS` of them, and one unit for the rest). This
  gives the classes of histories: that of the token before depends on its unit.
* Then over all words that occur :data:`LEAST` times or more, however many they are. A
  word's counts after each history class say which class it belongs to; the words are
  a Spark table, and only the table of history class by class is shared. Words
  of one hash part move together (:func:`improve`), and a turn counts only if it raises
  the likelihood.

Rarer words and words never seen are in the class of their ending.

Word counts are summed per batch before they are shuffled. A text is scored
beside the counts and classes of its own words only: documents are dealt into blocks of
about :data:`BLOCK_BYTES` of text, a block asks for its distinct words once, and meets the
answers by the same exchange.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batches, map_texts, mix, remainder, store

FREQUENT, ENDINGS, CLASSES = 600, 300, 32
#: Occurrences from which a word is moved on its own.
LEAST = 10
#: Gain of a turn (nats a token) below which it counts as still.
STILL = 1e-3
#: Most hash parts that the words are moved in; more parts, fewer moves at once.
PARTS = 64
BLOCK_BYTES = 16 << 20
#: Weight of the class frequencies in the smoothing of class transitions.
SMOOTH = 50.0


@dataclass(frozen=True)
class Units:
    """Which unit a word belongs to: 0 is the end mark, then the frequent words,
    the endings, and last the unit of all other words."""

    frequent: np.ndarray  # sorted hashes
    endings: np.ndarray  # sorted codes

    @property
    def size(self) -> int:
        return 2 + len(self.frequent) + len(self.endings)

    def of(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.size - 1, dtype=np.int64)
        for table, keys, offset in ((self.endings, endings, 1 + len(self.frequent)),
                                    (self.frequent, hashes, 1)):
            if len(table):
                at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                hit = table[at] == keys
                out[hit] = offset + at[hit]
        return out

    def of_endings(self, endings: np.ndarray) -> np.ndarray:
        """The units of words that have none of their own."""
        only = Units(np.zeros(0, np.uint64), self.endings)
        return only.of(np.zeros(len(endings), np.uint64), endings) + len(self.frequent)


def ending_codes(words: Words) -> np.ndarray:
    """The last two bytes of each word as a number."""
    last = words.data[words.end - 1].astype(np.int64)
    before = words.data[np.maximum(words.end - 2, 0)].astype(np.int64)
    return np.where(words.length > 1, before * 256 + last, last)


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = Words(batch["text"])
    value, at, n = np.unique(words.hash, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(value.view(np.int64)), pa.array(ending_codes(words)[at].astype(np.int32)),
         pa.array(n.astype(np.int64))], ["word", "ending", "n"])


def with_ends(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit sequences of texts, each between an end mark (unit 0) before it and
    one after it, and where each text's first token is."""
    counts = np.diff(first)
    start = first[:-1] + 2 * np.arange(len(counts)) + 1
    out = np.zeros(len(units) + 2 * len(counts), dtype=np.int64)
    out[np.arange(len(units)) + np.repeat(2 * np.arange(len(counts)) + 1, counts)] = units
    return out, start


def transitions(sequence: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbours inside texts: every token with the one before it."""
    keep = np.ones(len(sequence), dtype=bool)
    keep[start - 1] = False
    at = np.flatnonzero(keep)
    return sequence[at - 1], sequence[at]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each unit; the end mark keeps class 0 to itself.

    Starts with units dealt by frequency and moves one unit at a time to the
    class with the largest likelihood, ties to the smaller class. The unit's
    counts per class and the affected rows and columns of the class table are
    all that a move needs.
    """
    size = len(bigrams)
    freq = bigrams.sum(axis=0)
    order = [u for u in np.argsort(-freq, kind="stable") if u != 0]
    classes = max(2, min(classes, size))
    of = np.zeros(size, dtype=np.int64)
    for rank, u in enumerate(order):
        of[u] = 1 + rank % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1.0
    right = bigrams @ member          # unit followed by class
    left = bigrams.T @ member         # unit preceded by class
    table = member.T @ right          # class followed by class
    xlogx, moved = _xlogx, 1
    while moved:  # each move raises the likelihood, so this ends
        moved = 0
        for u in order:
            if freq[u] == 0:
                continue
            c, self_ = of[u], bigrams[u, u]
            r, l = right[u].copy(), left[u].copy()
            # take the unit out of its class
            table[c] -= r
            table[:, c] -= l
            table[c, c] += self_
            r[c] -= self_
            l[c] -= self_
            # the classes before and after the unit count it wherever it goes
            rows, columns = table.sum(axis=1) + l, table.sum(axis=0) + r
            # likelihood gain of putting it into each class k: row k gains r, column k gains l
            gain = (xlogx(table + r[None, :]) - xlogx(table)).sum(axis=1)
            gain += (xlogx(table + l[:, None]) - xlogx(table)).sum(axis=0)
            d = np.diagonal(table)
            gain += xlogx(d + r + l + self_) - xlogx(d + r) - xlogx(d + l) + xlogx(d)
            out_, in_ = r.sum() + self_, l.sum() + self_
            gain -= xlogx(rows + out_) - xlogx(rows) + xlogx(columns + in_) - xlogx(columns)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[c] + 1e-9:
                best = c
            r[best] += self_
            l[best] += self_
            table[best] += r
            table[:, best] += l
            table[best, best] -= self_
            if best != c:
                moved += 1
                of[u] = best
                row, column = bigrams[:, u], bigrams[u, :]
                right[:, c] -= row
                right[:, best] += row
                left[:, c] -= column
                left[:, best] += column
    return of


def likelihood(table: np.ndarray) -> float:
    """Of a table of history class by class, but for what no assignment changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum())


def best_classes(table: np.ndarray, of: np.ndarray, n: np.ndarray, first: np.ndarray,
                 before: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The class in which each word alone raises the likelihood most, its own on a tie
    (other ties: the smaller). Word ``k`` is in class ``of[k]``, occurs ``n[k]`` times, and
    ``m`` times after the history classes ``before`` from ``first[k]`` on."""
    word = np.repeat(np.arange(len(of)), np.diff(first))
    rows = table[before]
    rows[np.arange(len(rows)), of[word]] -= m
    gain = np.add.reduceat(_xlogx(rows + m[:, None]) - _xlogx(rows), first[:-1])
    sums = np.repeat(table.sum(axis=0)[None, :], len(of), axis=0)
    sums[np.arange(len(of)), of] -= n
    gain -= _xlogx(sums + n[:, None]) - _xlogx(sums)
    gain[:, 0] = -np.inf  # the end mark's
    best = gain.argmax(axis=1)
    at = np.arange(len(of))
    return np.where(gain[at, best] > gain[at, of] + 1e-9, best, of)


def _cells(words: DataFrame, size: int) -> np.ndarray:
    """The table of history class by class that ``words(class, hist)`` make."""
    cells = (words.select("class", F.explode("hist").alias("h")).groupBy("class", "h.before")
             .agg(F.sum("h.n").alias("n")).collect())  # size ** 2 rows at most
    table = np.zeros((size, size))
    for r in cells:
        table[r["before"], r["class"]] = r["n"]
    return table


def improve(words: DataFrame, table: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """Exchange over ``words(word, n, class, hist)``, of any number; ``table`` is that of history
    class by class over all tokens. Returns the words with their new classes and the new table.

    In each turn the words of one hash part move to their best classes. If they get in
    each other's way, so that the likelihood falls, the turn is undone and the parts
    become smaller. Ends when no part gains :data:`STILL` a token any more.
    """
    spark, size = words.sparkSession, len(table)
    rest = table - _cells(words, size)
    parts, still = 2, 0
    for turn in numbers():
        if still >= parts or parts > PARTS:
            return words, table
        shared = spark.sparkContext.broadcast(table)

        def move(it, shared=shared, parts=parts, turn=turn):
            for whole in it:
                for at in range(0, whole.num_rows, 2000):
                    batch = whole.slice(at, 2000)
                    first = np.concatenate([[0], np.cumsum(batch["hist"].value_lengths().to_numpy())])
                    hist = batch["hist"].flatten()
                    of = batch["class"].to_numpy().astype(np.int64)
                    best = best_classes(
                        shared.value, of, batch["n"].to_numpy().astype(np.float64), first,
                        hist.field("before").to_numpy().astype(np.int64),
                        hist.field("n").to_numpy().astype(np.float64))
                    mine = mix(batch["word"].to_numpy().view(np.uint64)) % np.uint64(parts) == turn % parts
                    yield pa.RecordBatch.from_arrays(
                        [batch["word"], batch["n"], pa.array(np.where(mine, best, of).astype(np.int32)),
                         batch["hist"]], ["word", "n", "class", "hist"])

        moved = store(words.select("word", "n", "class", "hist").mapInArrow(
            move, "word long, n long, class int, hist array<struct<before: int, n: long>>"))
        then = rest + _cells(moved, size)
        gain = likelihood(then) - likelihood(table)
        still = 0 if gain > STILL * max(table.sum(), 1.0) else still + 1
        if gain < 0:
            parts *= 2
        else:
            words, table = moved, then


@dataclass(frozen=True)
class Model:
    """Log probabilities of a token's class after the class before, the classes' tokens,
    and per unit the tokens and distinct words that are in the class of their ending."""

    units: Units
    of: np.ndarray  # class of each unit
    follow: np.ndarray  # log10 P(class | history class)
    mass: np.ndarray  # tokens of each class, and one more for each of its units
    tokens: np.ndarray
    words: np.ndarray
    total: int
    distinct: int

    def histories(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        return self.of[self.units.of(hashes, endings)]

    def log10(self, before: np.ndarray, classes: np.ndarray, units: np.ndarray,
              counts: np.ndarray) -> np.ndarray:
        """Of tokens after history classes. ``classes`` are those found for the words, -1
        for rare ones, whose ``units`` decide; a word never seen is one more possible word
        of its unit. Unit 0 is the end."""
        own = np.where(classes >= 0, classes, self.of[units])
        unit = self.tokens[units] + 1.0
        rare = unit * np.where(units == 0, 1.0, (counts + 1.0) / (unit + self.words[units]))
        inside = np.where(classes >= 0, counts, rare) / self.mass[own]
        return self.follow[before, own] + np.log10(inside)


def _bigrams(training: DataFrame, units: Units) -> np.ndarray:
    shared = training.sparkSession.sparkContext.broadcast(units)

    def run(it):
        table = shared.value
        total = np.zeros(table.size ** 2, dtype=np.int64)
        for batch in it:
            for part in batches(batch, "text"):
                found = Words(part["text"])
                sequence, start = with_ends(table.of(found.hash, ending_codes(found)), found.first)
                a, b = transitions(sequence, start)
                total += np.bincount(a * table.size + b, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    pairs = (training.select("text").mapInArrow(run, "pair long, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())  # size ** 2 rows at most
    bigrams = np.zeros(units.size ** 2)
    bigrams[pairs["pair"].to_numpy(np.int64)] = pairs["n"].to_numpy(np.float64)
    return bigrams.reshape(units.size, units.size)


def _after_classes(training: DataFrame, units: Units, of: np.ndarray) -> DataFrame:
    """``word, before, n``: how often each word without a unit of its own comes after each
    history class, summed per piece of text (a word can come more than once)."""
    shared = training.sparkSession.sparkContext.broadcast((units, of))

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        units, of = shared.value
        found = Words(part["text"])
        unit = units.of(found.hash, ending_codes(found))
        before = np.zeros(len(unit), dtype=np.int64)
        before[1:] = of[unit[:-1]]
        before[found.first[:-1][np.diff(found.first) > 0]] = 0
        rare = unit > len(units.frequent)
        value, at = np.unique(found.hash[rare], return_inverse=True)
        size = int(of.max()) + 1
        key, n = np.unique(at * size + before[rare], return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(value[key // size].view(np.int64)), pa.array((key % size).astype(np.int32)),
             pa.array(n.astype(np.int64))], ["word", "before", "n"])

    return map_texts(training.select("text"), "text", "word long, before int, n long", count)


def _seeds(words: DataFrame, units: Units, of: np.ndarray) -> DataFrame:
    """``words(word, ending, n, hist)`` in the classes of their units."""
    shared = words.sparkSession.sparkContext.broadcast((units, of))

    def run(it):
        for batch in it:
            units, of = shared.value
            unit = units.of(batch["word"].to_numpy().view(np.uint64), batch["ending"].to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["n"], pa.array(of[unit].astype(np.int32)), batch["hist"]],
                ["word", "n", "class", "hist"])

    return words.select("word", "ending", "n", "hist").mapInArrow(
        run, "word long, n long, class int, hist array<struct<before: int, n: long>>")


def fit(training: DataFrame, counts: DataFrame, ends: int, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """Learn from ``training(text)`` of ``ends`` rows and its stored word ``counts``. Returns the
    model and ``word, class`` of all words that were moved on their own."""
    spark = training.sparkSession
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64))
    others = counts.filter(~F.col("word").isin([r["word"] for r in top])) if top else counts
    few = F.col("n") < LEAST
    by_ending = others.groupBy("ending").agg(
        F.sum("n").alias("n"), F.sum(F.when(few, F.col("n")).otherwise(0)).alias("rare"),
        F.count_if(few).alias("v")).collect()
    by_ending.sort(key=lambda r: (-r["n"], r["ending"]))  # 65,792 endings at most
    units = Units(frequent, np.sort(np.array([r["ending"] for r in by_ending[:ENDINGS]], np.int64)))
    tokens, words = np.zeros(units.size), np.zeros(units.size)
    at = units.of_endings(np.array([r["ending"] for r in by_ending], dtype=np.int64))
    np.add.at(tokens, at, np.array([r["rare"] for r in by_ending], dtype=np.float64))
    np.add.at(words, at, np.array([r["v"] for r in by_ending], dtype=np.float64))
    tokens[0] = ends

    bigrams = _bigrams(training, units)
    of = exchange(bigrams, classes)
    k = int(of.max()) + 1
    member = np.zeros((units.size, k))
    member[np.arange(units.size), of] = 1.0
    after = member.T @ bigrams  # history class by unit

    many = others.filter(~few)
    seen = (_after_classes(training, units, of).join(many.select("word"), "word", "left_semi")
            .groupBy("word", "before").agg(F.sum("n").alias("n"))
            .groupBy("word").agg(F.collect_list(F.struct("before", "n")).alias("hist")))
    # frequent words, and only they, could be in every task: theirs are in the table of units
    hists = [(r["word"], r["ending"], r["n"], [
        (int(s), int(after[s, u])) for s in np.flatnonzero(after[:, u])]) for r in top for u in units.of(
            np.array([r["word"]], np.int64).view(np.uint64), np.zeros(1, np.int64))]
    kind = "word long, ending int, n long, hist array<struct<before: int, n: long>>"
    own = many.join(seen, "word").select("word", "ending", "n", "hist").unionByName(
        spark.createDataFrame(hists, kind))
    found = store(_seeds(own, units, of))
    found, table = improve(found, after @ member)

    units_of = np.bincount(np.concatenate([[0], of[1 + len(frequent):]]), minlength=k)
    mass = table.sum(axis=0) + units_of
    prior = mass / mass.sum()
    follow = np.log10((table + SMOOTH * np.maximum(prior, 1e-12)) / (table.sum(axis=1, keepdims=True) + SMOOTH))
    model = Model(units, of, follow, np.maximum(mass, 1.0), tokens, words, int(sums[0]) + ends,
                  int(sums[1]) + (1 if ends else 0))
    return model, found.select("word", "class")


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the lower-cased (A-Z) words of a text and one end. Learns from the
    rows whose ``crc32(id) mod 7`` is not 2, rows with a NULL id among them.
    ``base_score`` is the add-one unigram score, ``score`` that of the class model,
    both as log10 of the text's probability.

    * NULL, empty and blank texts are one end token.
    * Nothing to learn from: all counts are 0, the scores are still defined.
    * Repeated rows count and are scored each. Other columns are ignored.
    """
    rest = F.coalesce(remainder(doc_id, 7) == 2, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       rest.alias("held_out"))
    spark = rows.sparkSession
    size, ends = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))).first()
    training = rows.filter(~F.col("held_out")).select("text")
    counts = store(map_texts(training, "text", "word long, ending int, n long", _count)
                   .groupBy("word").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")))
    model, classes = fit(training, counts, ends)
    shared = spark.sparkContext.broadcast(model)
    blocks = 1 + size // BLOCK_BYTES
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows are dealt with their place, so that copies of a row are spread
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(
        "doc_id", "text", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    dealt = dealt.repartition(parts, "block")

    def ask(it):
        """The distinct words of each block (of the batches of a block, really)."""
        for batch in it:
            for part in batches(batch, "text"):
                block = part["block"].to_numpy()
                words = Words(part["text"])
                own = block[words.doc()]
                for b in np.unique(block):
                    found = np.unique(words.hash[own == b])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), b, np.int32)), pa.array(found.view(np.int64))],
                        ["block", "word"])

    asked = dealt.mapInArrow(ask, "block int, word long")  # all columns, so that the exchange is used twice
    answers = asked.join(counts.select("word", "n"), "word").join(classes, "word", "left").select(
        "block", "word", "n", F.coalesce("class", F.lit(-1)).alias("class"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        word, at = np.unique(right["word"].to_numpy().view(np.uint64), return_index=True)
        known = word, right["n"].to_numpy()[at].astype(np.float64), right["class"].to_numpy()[at].astype(np.int64)
        out = []
        for batch in left.to_batches():
            for part in batches(batch, "text"):
                out.append(one(shared.value, *known, part))
        return pa.Table.from_batches(out) if out else left.select([])

    def one(m: Model, word: np.ndarray, n: np.ndarray, of: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
        found = Words(part["text"])
        counted, own = np.zeros(len(found.hash)), np.full(len(found.hash), -1)
        if len(word):
            at = np.minimum(np.searchsorted(word, found.hash), len(word) - 1)
            hit = word[at] == found.hash
            counted[hit], own[hit] = n[at[hit]], of[at[hit]]
        endings = ending_codes(found)
        histories, start = with_ends(m.histories(found.hash, endings), found.first)
        units, counted, own = (with_ends(x, found.first)[0] for x in (m.units.of_endings(endings), counted, own + 1))
        token = np.ones(len(units), dtype=bool)
        token[start - 1] = False
        at = np.flatnonzero(token)
        tokens = np.diff(found.first) + 1
        first = np.concatenate([[0], np.cumsum(tokens)])[:-1]
        c = np.where(units[at] == 0, float(ends), counted[at])
        base = np.log10((c + 1.0) / (m.total + 1.0 * (m.distinct + 1)))
        mine = m.log10(histories[at - 1], own[at] - 1, units[at], c)
        return pa.RecordBatch.from_arrays(
            [part["doc_id"], part["held_out"], pa.array(tokens.astype(np.int64)),
             pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
             pa.array(np.full(len(part), m.total, np.int64)),
             pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(mine, first))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        judge, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
