"""Validity intervals: as-of and current tests, active counts, overlap, containment, versions, neighbours."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_date


def bound(*names: str) -> Column:
    """The first of some date texts that is not null, then parsed: a bad one is no bound and does not fall through."""
    return parse_date(F.coalesce(*[F.col(n) for n in names]))


def is_active_on(start: Column, end: Column, day: Column | dt.date | str | None) -> Column:
    """start <= day <= end, open where null; no day keeps everything. Written so that both halves reach the scan."""
    if day is None:
        return F.lit(True)
    d = day if isinstance(day, Column) else F.lit(day).cast("date")
    return (start.isNull() | (start <= d)) & (end.isNull() | (end >= d))


def started_by(instant: str, day: dt.date | str) -> Column:
    """Whether a timestamp lies on a day or before, as a test of the bare column, which reaches the scan (a cast to a date does not)."""
    after = dt.date.fromisoformat(str(day)) + dt.timedelta(days=1)
    return F.col(instant).isNull() | (F.col(instant) < F.lit(dt.datetime.combine(after, dt.time())).cast("timestamp_ntz"))


def active_on(records: DataFrame, day: dt.date | str | None, start: tuple[str, ...] = ("valid_from", "start_date"), end: tuple[str, ...] = ("valid_until", "end_date")) -> DataFrame:
    """Rows in force on a day; of the named columns those that exist count."""
    have = set(records.columns)
    low = [c for c in start if c in have]
    high = [c for c in end if c in have]
    null = F.lit(None).cast("date")
    return records.where(is_active_on(bound(*low) if low else null, bound(*high) if high else null, day))


def is_current(end: Column | str) -> Column:
    """No end date: null or empty. (Not a test against today.)"""
    end = F.col(end) if isinstance(end, str) else end
    return end.isNull() | (end.cast("string") == "")


def current(records: DataFrame, end: str = "end_date") -> DataFrame:
    return records.where(is_current(end))


def active_per_day(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """day, active: how many closed intervals hold each day on which the number changes.

    +1 on the first day and -1 on the day after the last, summed per day before the running sum: the window sees one row a
    day, however many intervals there are.
    """
    rise = intervals.where(F.col(start).isNotNull()).select(F.col(start).alias("day"), F.lit(1).alias("x"))
    fall = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(F.date_add(end, 1).alias("day"), F.lit(-1).alias("x"))
    per_day = rise.unionByName(fall).groupBy("day").agg(F.sum("x").alias("x"))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select("day", F.sum("x").over(running).alias("active"))


def on_every_day(changes: DataFrame, spine: DataFrame) -> DataFrame:
    """active on each day of a spine (column day), from the days of change; a row a day."""
    both = spine.select("day", F.lit(None).cast("long").alias("active"), F.lit(1).alias("wanted")).unionByName(changes.select("day", "active", F.lit(0).alias("wanted")))
    last = Window.orderBy("day", "wanted").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("day", "wanted", F.coalesce(F.last("active", True).over(last), F.lit(0)).alias("active")).where("wanted = 1").drop("wanted")


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Half-open overlap: each starts before the other ends; no end is never."""
    return (b_end.isNull() | (a_start < b_end)) & (a_end.isNull() | (b_start < a_end))


#: A key with more records than this has them paired by slices of time.
CROWDED = 1000
SLICE = "year"


def overlapping_pairs(records: DataFrame, key: str, position: str, start: str, end: str, crowded: int = CROWDED) -> DataFrame:
    """Pairs of a key's records whose intervals overlap, each once (key, a, b by position).

    An equi-join on the key with a residual test. The records of a crowded key meet by key and slice of time instead: the later start of
    an overlapping pair lies in a slice that the other interval touches, so no pair is lost and a hot key is split. (Open
    intervals end with the last slice of the records.)
    """
    r = records.select(F.col(key).alias("__key"), F.col(position).alias("p"), F.col(start).alias("s"), F.col(end).alias("e")).where("__key is not null and s is not null")
    many = r.groupBy("__key").agg(F.count("*").alias("__n")).where(F.col("__n") > crowded).select(F.col("__key").alias("__many"))
    few = r.join(many, F.col("__key") == F.col("__many"), "left_anti")
    x, y = (few.select("__key", *[F.col(c).alias(f"{c}{side}") for c in "pse"]) for side in "xy")
    test = overlaps(F.col("sx"), F.col("ex"), F.col("sy"), F.col("ey"))
    direct = x.join(y, "__key").where((F.col("px") < F.col("py")) & test).select("__key", F.col("px").alias("a"), F.col("py").alias("b"))
    crowd = r.join(many, F.col("__key") == F.col("__many"), "left_semi")
    last = crowd.groupBy("__key").agg(F.max("s").alias("last"))
    slice_of = lambda c: F.date_trunc(SLICE, c)
    until = F.least(F.coalesce("e", "last"), F.col("last"))
    spans = crowd.join(last, "__key").withColumn("slice", F.explode(F.sequence(slice_of(F.col("s")), F.greatest(slice_of(until), slice_of(F.col("s"))), F.expr(f"interval 1 {SLICE}"))))
    x = spans.select("__key", "slice", *[F.col(c).alias(f"{c}x") for c in "pse"])
    y = crowd.select("__key", slice_of(F.col("s")).alias("slice"), *[F.col(c).alias(f"{c}y") for c in "pse"])
    first = (F.col("sx") < F.col("sy")) | ((F.col("sx") == F.col("sy")) & (F.col("px") < F.col("py")))
    sliced = x.join(y, ["__key", "slice"]).where(first & (F.col("px") != F.col("py")) & test)
    both = direct.unionByName(sliced.select("__key", F.least("px", "py").alias("a"), F.greatest("px", "py").alias("b")))
    return both.withColumnRenamed("__key", key)


def not_contained(inner: DataFrame, outer: DataFrame, key: str, start: str, end: str, outer_start: str, outer_end: str) -> DataFrame:
    """Rows of inner that reach outside the validity of the outer row with their key (rows without one stay out)."""
    o = outer.select(F.col(key), F.col(outer_start).alias("__from"), F.col(outer_end).alias("__until"))
    early = F.col(start) < F.col("__from")
    late = F.col("__until").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("__until")))
    return inner.join(o, key).where(F.coalesce(early, F.lit(False)) | F.coalesce(late, F.lit(False))).withColumn("early", F.coalesce(early, F.lit(False))).withColumn("late", F.coalesce(late, F.lit(False))).drop("__from", "__until")


def version_order(end: str, start: str, position: str) -> list[Column]:
    """Open versions first, then the latest end, the latest start, the last position (own rule)."""
    return [F.col(end).isNull().desc(), F.col(end).desc_nulls_last(), F.col(start).desc_nulls_last(), F.col(position).desc()]


def _rank(end: str, start: str, position: str) -> Column:
    """version_order as one value: the largest is the version that counts."""
    return F.struct(F.col(end).isNull().cast("int").alias("open"), F.col(end).alias("end"), F.col(start).alias("start"), F.col(position).alias("position"))


def latest_version(versions: DataFrame, key: str, start: str, end: str, position: str) -> DataFrame:
    """The version of each key that counts as current (version_order); an aggregate, so nothing is sorted and a hot key is combined early."""
    others = [c for c in versions.columns if c != key]
    best = versions.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), _rank(end, start, position)).alias("__best"))
    return best.select(*[F.col(f"`{c}`") if c == key else F.col(f"__best.`{c}`").alias(c) for c in versions.columns])


def version_at(facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, end: str, position: str) -> DataFrame:
    """Each fact with the version of its key in force at its date (closed interval), null columns where none is.

    No fact meets a version: both are ordered by date within a key and month, and the largest version so far, by version_order, is
    carried along, with the largest of all months before. It ends last, so if it has ended by then no other is in force.
    """
    columns = [c for c in versions.columns if c != key]
    kinds = versions.select(F.struct(*columns).alias("v"), _rank(end, start, position).alias("o")).schema
    nothing = F.lit(None)
    f = facts.select(F.col(key).alias("__key"), F.col(at).cast("date").alias("__day"), F.lit(1).alias("__turn"), F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("__fact"), nothing.cast(kinds["v"].dataType).alias("v"), nothing.cast(kinds["o"].dataType).alias("o"))
    v = versions.select(F.col(key).alias("__key"), F.col(start).cast("date").alias("__day"), F.lit(0).alias("__turn"), nothing.cast(f.schema["__fact"].dataType).alias("__fact"), F.struct(*columns).alias("v"), _rank(end, start, position).alias("o"))
    both = f.unionByName(v).withColumn("__month", F.trunc("__day", "month"))
    whole = F.struct("o", "v")
    so_far = Window.partitionBy("__key", "__month").orderBy(F.col("__day").asc_nulls_first(), "__turn").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("__in", F.max_by(whole, "o").over(so_far)).where("__turn = 1")
    months = both.groupBy("__key", "__month").agg(F.max_by(whole, "o").alias("__best"))
    earlier = Window.partitionBy("__key").orderBy(F.col("__month").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carried = months.select(F.col("__key").alias("__k"), F.col("__month").alias("__m"), F.max_by("__best", F.col("__best.o")).over(earlier).alias("__before"))
    joined = inside.join(carried, F.col("__key").eqNullSafe(F.col("__k")) & F.col("__month").eqNullSafe(F.col("__m")))
    a, b = F.col("__in"), F.col("__before")
    best = F.when(a["o"].isNull(), b).when(b["o"].isNull() | (a["o"] >= b["o"]), a).otherwise(b)
    found = joined.select("__fact", "__key", best.alias("__x"), F.col("__day").alias("__on"))
    holds = F.col("__key").isNotNull() & F.col("__x.o").isNotNull() & (F.col("__x.o.end").isNull() | (F.col("__x.o.end").cast("date") >= F.col("__on")))
    return found.select("__fact.*", *[F.when(holds, F.col(f"__x.v.`{c}`")).alias(c) for c in columns])


def neighbours(records: DataFrame, key: str, order: list[str], start: str, end: str) -> DataFrame:
    """records with the end of the previous and the start of the next one of their key, and the gap in days before them."""
    w = Window.partitionBy(key).orderBy(*order)
    out = records.withColumn("previous_end", F.lag(end).over(w)).withColumn("next_start", F.lead(start).over(w))
    return out.withColumn("gap_days", F.datediff(F.col(start), F.col("previous_end")))
