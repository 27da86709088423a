"""Gates whose counts come from the run itself.

``Ledger.step`` hangs aggregates on a DataFrame (``observe``): they are counted while its rows pass on their way to a write, so no gate scans a table
again. A step's figures are there once the action over it has run. ``balance`` then checks equations between figures of different steps:
every row that went in must have come out somewhere.

A figure is counted in the stage that the step's rows pass through. Hang steps on what a write consumes and not before a shuffle, so that a stage that
is run anew after a lost executor isn't counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.gates import GateError


class Ledger:
    """Figures by step and name."""

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}
        self._known: dict[tuple[str, str], int] = {}

    def step(self, name: str, df: DataFrame, **figures: Column) -> DataFrame:
        """``df`` with ``rows`` and the given aggregates counted as it passes."""
        if name in self._steps:
            raise ValueError(f"two steps are called {name}")
        self._steps[name] = Observation(f"step-{name}")
        return df.observe(self._steps[name], F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in figures.items()))

    def __getitem__(self, at: tuple[str, str]) -> int:
        """The figure (step, name); waits for the step's action."""
        if at not in self._known:
            for name, value in self._steps[at[0]].get.items():
                self._known[(at[0], name)] = value or 0
        return self._known[at]

    def balance(self, spark: SparkSession, equations: dict[str, tuple[Callable[[Ledger], int], Callable[[Ledger], int]]]) -> DataFrame:
        """gate, expected, actual, ok: one row for each equation; both sides are sums of figures."""
        rows = [(gate, int(want(self)), int(got(self))) for gate, (want, got) in equations.items()]
        return spark.createDataFrame([(g, w, h, w == h) for g, w, h in rows], "gate string, expected long, actual long, ok boolean")


def insist(balance: DataFrame) -> None:
    """Raise if an equation doesn't hold."""
    wrong = balance.where("not ok").collect()
    if wrong:
        raise GateError("; ".join(f"{r['gate']}: {r['expected']} expected, {r['actual']} found" for r in wrong))
