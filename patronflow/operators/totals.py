"""Control totals that a report computes in the job that makes it.

A total is observed where the rows pass (``DataFrame.observe``), so it costs no
further scan. Totals that have to agree, the valid orders that went into a
report and those it shows for instance, are compared once the job is done; a
report that lost or doubled rows is not published (:func:`..sources.publish`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation


class TotalsDiffer(ValueError):
    """Totals that have to agree do not."""


class Totals:
    """The totals of one run of a report."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}
        self._rules: list[tuple[tuple[str, ...], float]] = []

    def watch(self, df: DataFrame, name: str, **totals: Column) -> DataFrame:
        """The same rows, with aggregates over them observed as ``name.total``.

        Watch a point that one job passes once: a table behind two joins is read,
        and observed, twice.
        """
        if name in self._watched:
            raise ValueError(f"{name} is watched already; take new Totals for each run")
        self._watched[name] = Observation()
        return df.observe(self._watched[name], *[c.alias(t) for t, c in totals.items()])

    def agree(self, *names: str, tolerance: float = 0.0) -> None:
        """The named totals have to be equal, up to a relative tolerance."""
        self._rules.append((names, tolerance))

    def values(self) -> dict[str, object]:
        """All totals; call it after the actions that compute them."""
        return {f"{name}.{total}": value for name, seen in self._watched.items()
                for total, value in seen.get.items()}

    def verify(self) -> dict[str, object]:
        """The totals, or :class:`TotalsDiffer` with those that do not agree."""
        values = self.values()
        wrong = []
        for names, tolerance in self._rules:
            known = [values[n] or 0 for n in names]
            if not all(math.isclose(known[0], v, rel_tol=tolerance, abs_tol=tolerance)
                       for v in known):
                wrong.append(", ".join(f"{n} = {v}" for n, v in zip(names, known)))
        if wrong:
            raise TotalsDiffer("; ".join(wrong))
        return values


def watched(totals: Totals | None, df: DataFrame, name: str, **sums: Column) -> DataFrame:
    """:meth:`Totals.watch` where a report was given totals, else the table."""
    return df if totals is None else totals.watch(df, name, **sums)
