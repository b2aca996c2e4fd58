"""Text rules: ordered pattern rules, token picks and ASCII folding."""

from __future__ import annotations

import unicodedata
import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col


class Rule(NamedTuple):
    """A label and the regular expressions that select it.

    ``exact`` lists whole values that select the label as well.
    """

    label: str
    patterns: Sequence[str] = ()
    exact: Sequence[str] = ()

    def test(self, column: str) -> str:
        """SQL condition on a column; a NULL value gives NULL."""
        tests = [_match_sql(column, p) for p in self.patterns]
        tests += [f"{column} = {_literal(value)}" for value in self.exact]
        return "(" + " OR ".join(tests) + ")"

    def hits(self, value: str) -> bool:
        """The same test on a known value."""
        return value in self.exact or any(re.search(p, value) for p in self.patterns)


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _match_sql(column: str, pattern: str) -> str:
    # A pattern without special characters is a plain substring, and looking
    # for a substring is much cheaper than running a regular expression.
    plain = re.escape(pattern).replace("\\ ", " ").replace("\\-", "-") == pattern
    function = "contains" if plain else "rlike"
    return f"{function}({column}, {_literal(pattern)})"


def matches(column: str, patterns: str | Iterable[str]) -> Column:
    """Unanchored, case-sensitive regex test; several patterns are alternatives."""
    patterns = [patterns] if isinstance(patterns, str) else list(patterns)
    return F.expr(Rule("", patterns).test(column))


def last_match(column: str, rules: Sequence[Rule], default: str) -> Column:
    """Label of the last rule that matches the *original* value.

    One CASE with the rules in reverse order. A NULL value matches nothing and
    takes the default, a SQL expression.
    """
    branches = " ".join(f"WHEN {rule.test(column)} THEN {_literal(rule.label)}"
                        for rule in reversed(rules))
    return F.expr(f"CASE {branches} ELSE {default} END")


def cascade(df: DataFrame, column: str, rules: Sequence[Rule]) -> DataFrame:
    """Apply rules one after another to a column, each on the rewritten value.

    A later rule sees the label an earlier rule wrote. The labels are known, so
    where each one ends up is worked out here and one CASE is left: the first
    rule to hit decides.
    """
    branches = []
    for i, rule in enumerate(rules):
        label = rule.label
        for later in rules[i + 1:]:
            if later.hits(label):
                label = later.label
        branches.append(f"WHEN {rule.test(column)} THEN {_literal(label)}")
    return df.withColumn(column, F.expr(f"CASE {' '.join(branches)} ELSE {column} END"))


def split_pick(column: ColumnLike, separator: str, index: int) -> Column:
    """Token at a 0-based position, NULL beyond the end."""
    return F.get(F.split(as_col(column), separator), F.lit(index))


def first_name(column: ColumnLike) -> Column:
    """Text before the first blank."""
    return F.regexp_replace(as_col(column), " .*$", "")


# Letters without a decomposition, quotes and dashes.
_FOLD_PLAIN = {"Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l",
               "Ħ": "H", "ħ": "h", "ı": "i", "Ŧ": "T", "ŧ": "t", "ŋ": "n", "Ŋ": "N", "ƀ": "b",
               "“": '"', "”": '"', "„": '"', "‘": "'", "’": "'", "‚": "'", "–": "-", "—": "-"}


def _fold_table() -> dict[str, str]:
    """One character for one: Latin-1, Extended-A and -B and Extended Additional
    by their decomposition, then the fixed values."""
    table = {}
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(point))
                       if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base != chr(point):
            table[chr(point)] = base
    return {**table, **_FOLD_PLAIN}


# Letters that fold to two.
_FOLD_PAIRS = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe",
               "Þ": "TH", "þ": "th"}


def fold_ascii(column: ColumnLike) -> Column:
    """Latin letters to plain ASCII, with built-in expressions only."""
    table = _fold_table()
    folded = F.translate(as_col(column), "".join(table), "".join(table.values()))
    folded = F.regexp_replace(folded, "\\p{M}", "")
    for letter, pair in _FOLD_PAIRS.items():
        folded = F.replace(folded, F.lit(letter), F.lit(pair))
    return folded
