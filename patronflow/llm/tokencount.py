"""Operator 10: token counts under a unigram vocabulary, shared along a trie.

The best segmentation of a pre-token under a unigram model is found by a forward
pass whose score at a position depends on the prefix up to it alone. Distinct
pre-tokens are therefore inserted into a trie and visited in sorted order, which
is a walk over that trie: the scores of a shared prefix are computed once, and
the count of tokens is stored where a pre-token ends. Only the path from the
root is held, so memory follows the longest pre-token.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_texts

#: Marks the beginning of a word in the vocabulary.
BEGIN = "▁"


class Unigram:
    """Pieces with log probabilities; an unknown character is one token at
    ``unknown``, below every piece."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - 10.0
        #: Lengths that occur among the pieces with a given last character.
        self.lengths: dict[str, list[int]] = {}
        seen: dict[str, set[int]] = {}
        for piece in scores:
            seen.setdefault(piece[-1], set()).add(len(piece))
        for last, sizes in seen.items():
            self.lengths[last] = sorted(sizes, reverse=True)

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of the best segmentation of each of the sorted, distinct
        ``words``. Of equal scores the one with the longest last piece counts."""
        scores, unknown, lengths = self.scores, self.unknown, self.lengths
        best, count, out = [0.0], [0], []
        path = ""
        for word in words:
            word = BEGIN + word
            shared, end = 0, min(len(path), len(word))
            while shared < end and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1:], count[shared + 1:]
            for j in range(shared + 1, len(word) + 1):
                top, tokens = best[j - 1] + unknown, count[j - 1] + 1
                for size in lengths.get(word[j - 1], ()):
                    i = j - size
                    if i >= 0:
                        value = scores.get(word[i:j])
                        if value is not None and best[i] + value > top:
                            top, tokens = best[i] + value, count[i] + 1
                best.append(top)
                count.append(tokens)
            path = word
            out.append(count[-1])
        return out


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Unigram:
    """Pieces of a public sentencepiece vocabulary. It is a merge vocabulary, in
    order of merging, so a piece of rank r gets the log probability of a Zipf law,
    -ln(r + 1). Control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(k) for k in range(model.get_piece_size())
             if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)
                     or model.is_unused(k))]
    return Unigram({p: -math.log(r + 1.0) for r, p in enumerate(plain)})


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_distinct_words, n_tokens`` of every document.

    Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+``, with their case. NULL, empty
    and blank texts count 0. A text without blanks is one long pre-token. Other
    columns are ignored; no rows: no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch["text"], lower=False)
        _, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        distinct = [words.text(k) for k in at]
        order = sorted(range(len(distinct)), key=distinct.__getitem__)
        tokens = np.zeros(len(distinct), dtype=np.int64)
        tokens[order] = vocabulary(path).counts([distinct[k] for k in order])
        total = np.concatenate([[0], np.cumsum(tokens[inverse])]) if len(distinct) else np.zeros(1, np.int64)
        doc = words.doc().astype(np.int64)
        pairs = np.unique(doc * max(len(distinct), 1) + inverse) // max(len(distinct), 1)
        n = len(batch)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(np.diff(words.first)),
             pa.array(np.bincount(pairs, minlength=n).astype(np.int64)[:n]),
             pa.array(total[words.first[1:]] - total[words.first[:-1]])],
            ["doc_id", "n_words", "n_distinct_words", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {kind}, n_words long, n_distinct_words long, n_tokens long", run)
