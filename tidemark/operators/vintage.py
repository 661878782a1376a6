"""Bitemporal reads: which value of a period was known when.

Every read groups or windows by the series' keys, so its shuffle deals out by key and the last step stays within a key. Orders are
always total: the caller names tie-breaks after the vintage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import intervals


def latest_vintage(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key. One aggregation that combines before the shuffle, so hot keys cost one row a task."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*")


def latest_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in any order, mixed directions too."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def first_print(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*keys, "__row.*")


#: Origins, and days of a calendar, that are sent to every task at most; more of them meet the rows by a shuffle.
MAX_SENT = 40_000


def validity(df: DataFrame, keys: Sequence[str], vintage: str, tie: Sequence[str] = (), stamp: str | None = None) -> DataFrame:
    """Each row that some origin reads, with the days ``__from`` (null: always) and ``__until`` (exclusive; null: for good) of the origins
    that do: from its vintage to the next one; and the earliest row of a key also before that.

    Vintages of a key are reduced to one row each where they lie, so the window sees no more rows of a hot key than it has vintages.
    ``stamp``: a column of days that rises with the vintage and stands for it in spans; rows of one stamp become one. A null stamp is
    that of rows which are only read as the earliest.
    """
    by = stamp or vintage
    rest = [c for c in df.columns if c not in (*keys, vintage, by)]
    order, row = F.struct(vintage, *(tie or rest)), F.struct(*[c for c in (vintage, *rest)])
    per = df.where(F.col(vintage).isNotNull()).groupBy(*keys, F.col(by).alias("__by")).agg(F.max_by(row, order).alias("__row"), F.min_by(row, order).alias("__first"))
    run = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("__by"))
    spans = per.withColumns({"__until": F.lead("__by").over(run), "__n": F.row_number().over(run)})
    known = F.struct(F.col("__by").alias("__from"), F.col("__until"), F.col("__row"))
    # the earliest vintage stands in for origins before it
    before = F.struct(F.lit(None).cast(df.schema[by].dataType).alias("__from"), F.col("__by").alias("__until"), F.col("__first").alias("__row"))
    pieces = F.filter(F.array(F.when(F.col("__n") == 1, before), F.when(F.col("__by").isNotNull(), known)), lambda p: p.isNotNull())
    return spans.select(*keys, F.explode(pieces).alias("__p")).select(*keys, "__p.__from", "__p.__until", "__p.__row.*")


def _day_on(c: Column) -> Column:
    """The first day that is no earlier."""
    day = c.cast("date")
    return F.when(day < c, F.date_add(day, 1)).otherwise(day)


def as_of_many(
    df: DataFrame,
    origins: DataFrame,
    keys: Sequence[str],
    period: str,
    vintage: str,
    tie: Sequence[str] = (),
    use_vintages: bool = True,
    ahead_months: int = 0,
    max_sent: int = MAX_SENT,
) -> DataFrame:
    """For every origin (column ``origin``) and key with period up to it: the latest vintage known then, else the earliest ever. Rows
    without a vintage are never read.

    A row becomes the span of days on which it is the one to read. Spans and origins meet over equal blocks of days (see
    ``intervals``), a few for each span whatever the number of origins, and the join makes no row that is not in the result. Vintages between
    two origins are one to all origins, so they are reduced to one row before the shuffle: a day's next origin is looked
    up in a calendar. Up to ``max_sent`` origins and days of the calendar are sent to the tasks; more are joined by a shuffle.
    """
    origins = origins.select(F.col("origin").cast("date")).where("origin IS NOT NULL").distinct()
    low, high, n = origins.agg(F.min("origin"), F.max("origin"), F.count("*")).first()
    if not n:
        return df.select(F.lit(None).cast("date").alias("origin"), *df.columns).limit(0)
    sent = lambda rows, size: F.broadcast(rows) if size <= max_sent else rows
    first, days = F.lit(low), (high - low).days + 1
    if use_vintages:
        # the first origin from each day on
        calendar = df.sparkSession.range(1).select(F.explode(F.sequence(first, F.lit(high))).alias("__day")).join(origins, F.col("__day") == F.col("origin"), "left")
        ahead = Window.orderBy("__day").rowsBetween(0, Window.unboundedFollowing)
        calendar = calendar.select("__day", F.min("origin").over(ahead).alias("__stamp"))
        day = F.greatest(_day_on(F.col(vintage)), first)
        rows = df.withColumn("__day", day).join(sent(calendar, days), "__day", "left").drop("__day")
        rows = validity(rows, keys, vintage, tie, "__stamp")
    else:
        null = F.lit(None).cast("date")
        rows = latest_vintage(df, keys, [vintage, *tie]).withColumns({"__from": null, "__until": null})
    reached = _day_on(F.col(period))
    if ahead_months:
        reached = F.add_months(reached, -ahead_months)
        reached = F.when(F.add_months(reached, ahead_months) >= F.col(period), reached).otherwise(F.date_add(reached, 1))
    # days are numbered from the first origin
    begin = F.greatest(F.datediff(F.greatest(F.coalesce("__from", first), reached), first), F.lit(0))
    end = F.least(F.datediff(F.coalesce("__until", F.date_add(F.lit(high), 1)), first) - 1, F.lit(days - 1))
    rows = rows.where(F.col(period).isNotNull()).withColumns({"__a": begin, "__b": end}).where("__a <= __b")
    depth = intervals.levels(days)
    rows = rows.withColumn("__block", F.explode(intervals.blocks_of_span(F.col("__a"), F.col("__b"), depth)))
    asked = origins.select("origin", F.explode(intervals.blocks_of_day(F.datediff("origin", first), depth)).alias("__block"))
    return rows.join(sent(asked, n), "__block").select("origin", *df.columns)


def as_of(df: DataFrame, origin: str, keys: Sequence[str], period: str, vintage: str, tie: Sequence[str] = (), **how) -> DataFrame:
    origins = df.sparkSession.range(1).select(F.lit(origin).cast("date").alias("origin"))
    return as_of_many(df, origins, keys, period, vintage, tie, **how).drop("origin")


def revision_trajectory(seen: DataFrame, keys: Sequence[str], period: str, value: str, target: str) -> DataFrame:
    """From as-of reads (column ``origin``), per key and origin what was known of the target period (``signal``) and the latest value of
    the periods before it (``prior``): the inputs of a blend as it would have been on each day."""
    own = F.col(period) == F.lit(target).cast("date")
    earlier = F.col(period) < F.lit(target).cast("date")
    return seen.groupBy("origin", *keys).agg(
        F.max(F.when(own, F.col(value))).alias("signal"), F.max_by(F.when(earlier, F.col(value)), F.when(earlier, F.col(period))).alias("prior")
    )


def as_of_released(df: DataFrame, origin: str, keys: Sequence[str], order: Sequence[str], vintage: str, released: Column) -> DataFrame:
    """Latest vintage up to the origin, of periods whose computed release date is no later than it."""
    day = F.lit(origin).cast("date")
    return latest_vintage(df.where((F.col(vintage) <= day) & (released <= day)), keys, order)


def source_fallback(df: DataFrame, keys: Sequence[str], source: str, preferred: str, value: str) -> DataFrame:
    """The preferred source's value where there is one, else another's."""
    first = F.max(F.when(F.col(source) == preferred, F.col(value)))
    return df.groupBy(*keys).agg(F.coalesce(first, F.max(F.when(F.col(source) != preferred, F.col(value)))).alias(value))


def latest_group_filter(df: DataFrame, group: str) -> DataFrame:
    """Rows of the greatest group value: a one-row aggregate joined back."""
    top = df.agg(F.max(group).alias("__top"))
    return df.join(F.broadcast(top), F.col(group) == F.col("__top")).drop("__top")


def current_view(df: DataFrame, keys: Sequence[str], order: Sequence[str], active: Column | None = None) -> DataFrame:
    return latest_vintage(df if active is None else df.where(active), keys, order)


def current_slice(df: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """All rows of each key's newest stamp."""
    top = df.groupBy(*keys).agg(F.max(stamp).alias("__top"))
    return df.join(top, list(keys)).where(F.col(stamp) == F.col("__top")).drop("__top")


def revision_summary(df: DataFrame, keys: Sequence[str], order: Sequence[str], vintage: str, value: str) -> DataFrame:
    by = F.struct(*order)
    out = df.groupBy(*keys).agg(
        F.min_by(value, by).alias("first_value"), F.max_by(value, by).alias("latest_value"), F.count_distinct(vintage).alias("n_vintages"), F.count("*").alias("n_rows")
    )
    return out.withColumn("revision", F.col("latest_value") - F.col("first_value"))


def stage_revision(df: DataFrame, keys: Sequence[str], stage: str, value: str, early: str, late: str) -> DataFrame:
    """Value of the late stage less that of the early one."""
    wide = df.groupBy(*keys).pivot(stage, [early, late]).agg(F.first(value))
    return wide.withColumn("stage_revision", F.col(late) - F.col(early))
