"""Functions that users register: an aggregate and a table function, on Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def span(x: pd.Series) -> float:
    """The largest value minus the smallest (null without any)."""
    return x.max() - x.min()


@F.udtf(returnType=T.StructType([T.StructField("position", T.IntegerType())]))
class Positions:
    """A row for each number under n (none for null)."""

    def eval(self, n: int):
        for k in range(n or 0):
            yield (k,)


def register(spark: SparkSession) -> None:
    """span and positions for SQL."""
    spark.udf.register("span", span)
    spark.udtf.register("positions", Positions)


def span_of(x: Column | str) -> Column:
    """The same in generated code, which combines before the shuffle."""
    return F.max(x) - F.min(x)
