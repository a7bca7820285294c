"""Joins by a stated strategy, for where the optimiser's choice is known to be wrong; the rows are the same by all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

#: Hints by strategy; "auto" leaves the choice to the optimiser.
STRATEGIES = {"auto": None, "broadcast": "broadcast", "sort_merge": "shuffle_merge", "hash": "shuffle_hash", "nested_loop": "shuffle_replicate_nl"}


def join_by(left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner", strategy: str = "auto") -> DataFrame:
    """left joined with right, the hint on the right side. (broadcast: right must be of a bounded size; nested_loop: inner joins only.)"""
    hint = STRATEGIES[strategy]
    return left.join(right.hint(hint) if hint else right, on, how)
