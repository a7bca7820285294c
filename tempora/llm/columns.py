"""Column names with dots or backticks, which neither Arrow maps nor plain references to columns take."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: What stands for a dot and a backtick while a table passes through an operator.
STAND_INS = {".": "\ue000", "`": "\ue001"}


def plain_name(name: str) -> str:
    return name.translate(str.maketrans(STAND_INS))


def plain(df: DataFrame) -> DataFrame:
    """df with stand-ins for dots and backticks in names."""
    names = [plain_name(c) for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


def named(df: DataFrame) -> DataFrame:
    """df with the names that it had before plain()."""
    back = str.maketrans({v: k for k, v in STAND_INS.items()})
    names = [c.translate(back) for c in df.columns]
    return df if names == df.columns else df.toDF(*names)
