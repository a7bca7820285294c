"""A costly call per row (a skill), behind a prefilter, a response cache and a budget.

The answerer is any function from texts to texts; the default answers nothing and needs no network. Rows whose answer is cached cost nothing; of
the others those that fit the budget, in order, are answered in Arrow batches on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import content_hash
from .budget import admit

#: What a process exits with when its rate limit is reached (own choice).
RATE_LIMIT_EXIT_CODE = 75


@dataclass
class SkillResult:
    text: str | None
    cost: float = 0.0
    cached: bool = False


class SkillSession:
    """Answers one after another with a memo by content."""

    def __init__(self, skill: str, answer: Callable[[str], str | None] | None = None, cost: float = 0.0):
        self.skill, self.answer, self.cost = skill, answer or (lambda _: None), cost
        self._memo: dict[str, str | None] = {}

    def ask(self, prompt: str) -> SkillResult:
        if prompt in self._memo:
            return SkillResult(self._memo[prompt], 0.0, True)
        self._memo[prompt] = self.answer(prompt)
        return SkillResult(self._memo[prompt], self.cost)

    def drain(self, prompts: Iterable[str]) -> list[SkillResult]:
        return [self.ask(p) for p in prompts]


def run_skill(skill: str, prompts: Iterable[str], answer: Callable[[str], str | None] | None = None) -> list[SkillResult]:
    return SkillSession(skill, answer).drain(prompts)


def relevant(rows: DataFrame, text: str, pattern: str) -> DataFrame:
    """Rows worth a call; a filter before the call, as none moves through it by itself."""
    return rows.where(F.col(text).rlike(pattern))


def answers(rows: DataFrame, text: str, skill: str, answer: Callable[[str], str | None], *, cache: DataFrame | None = None, order: str | None = None, cost: str | None = None, limit: float | None = None) -> DataFrame:
    """rows with key (hash of skill and text), answer and cached. cache has key and answer; rows beyond the limit have no answer."""
    keyed = rows.withColumn("key", content_hash(F.lit(skill), text))
    if cache is not None:
        known = cache.select(F.col("key").alias("__k"), F.col("answer").alias("__known")).dropDuplicates(["__k"])
        keyed = keyed.join(known, F.col("key") == F.col("__k"), "left").withColumn("cached", F.col("__k").isNotNull()).drop("__k")
    else:
        keyed = keyed.withColumn("__known", F.lit(None).cast("string")).withColumn("cached", F.lit(False))
    if order is not None and cost is not None:
        keyed = admit(keyed.withColumn("__cost", F.when(F.col("cached"), 0).otherwise(F.col(cost))), order, "__cost", limit).drop("__cost", "spent_before")
    else:
        keyed = keyed.withColumn("admitted", F.lit(True))

    def call(batches):
        session = SkillSession(skill, answer)
        for batch in batches:
            ask = batch["admitted"] & ~batch["cached"]
            batch["answer"] = batch["__known"].where(~ask, pd.Series([session.ask(t).text if a else None for t, a in zip(batch[text], ask, strict=True)], index=batch.index, dtype=object))
            yield batch.drop(columns="__known")

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields if f.name != "__known"]
    return keyed.mapInPandas(call, ", ".join([*fields, "answer string"]))


def backfill(snapshots: DataFrame, text: str, skill: str, answer: Callable[[str], str | None], workers: int, **options) -> DataFrame:
    """Stored snapshots through a skill again, dealt to so many workers."""
    return answers(snapshots.repartition(workers), text, skill, answer, **options)
