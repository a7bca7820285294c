"""Cost budgets: a call is admitted while the cost of all earlier calls is below the limit."""

from __future__ import annotations

import threading
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import sum_before


def exceeded(spent: Column | str, limit: float | Decimal | None) -> Column:
    """Whether a limit is reached; no limit never is."""
    if limit is None:
        return F.lit(False)
    return (F.col(spent) if isinstance(spent, str) else spent) >= F.lit(limit)


def admit(calls: DataFrame, order: str, cost: str, limit: float | Decimal | None, tie: tuple[str, ...] = ()) -> DataFrame:
    """calls with spent_before and admitted. Deterministic: the order of the column decides, not the timing of workers."""
    spent = sum_before(calls, order, cost, "spent_before", tie=tie)
    return spent.withColumn("admitted", ~exceeded("spent_before", limit))


class CostLedger:
    """A running total that threads of the driver share. Spark sums for reports use spent().

    add() and exceeded() are the loose protocol (ask before a call, add after it: threads may overshoot together); charge() does
    both at once under the lock, so no call is admitted after the limit is reached.
    """

    def __init__(self, limit_usd: float | None):
        self._limit, self._total, self._guard = limit_usd, 0.0, threading.RLock()

    @property
    def limit_usd(self) -> float | None:
        return self._limit

    @property
    def spent_usd(self) -> float:
        with self._guard:
            return self._total

    def exceeded(self) -> bool:
        return self._limit is not None and self.spent_usd >= self._limit

    def add(self, cost_usd: float) -> None:
        with self._guard:
            self._total += cost_usd

    def charge(self, cost_usd: float) -> bool:
        """Whether a call is admitted; if so its cost is added."""
        with self._guard:
            admitted = not self.exceeded()
            if admitted:
                self.add(cost_usd)
            return admitted

    @staticmethod
    def spent(calls: DataFrame, cost: str) -> DataFrame:
        return calls.agg(F.coalesce(F.sum(cost), F.lit(0)).alias("spent"))
