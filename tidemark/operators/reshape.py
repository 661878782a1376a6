"""Joins, pivots, calendars and buckets.

Windows are partitioned by series; range joins have a stated small side; pivots name their values, so no pass looks for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def densify(df: DataFrame, keys: Sequence[str], period: str, step: str = "1 month", extra: int = 0) -> DataFrame:
    """Every period of a key between its first and last, ``extra`` ones more; values of absent periods are null.

    Each row adds the periods up to the next row of its key: one shuffle by key, which windows after it share, and no join.
    """
    run = Window.partitionBy(*keys).orderBy(period)
    upto = F.coalesce(F.expr(f"__next - interval {step}"), F.expr(f"`{period}` + {extra} * interval {step}")).cast("date")
    rows = df.where(F.col(period).isNotNull()).withColumn("__next", F.lead(period).over(run))
    rows = rows.withColumn("__p", F.explode(F.sequence(F.col(period), F.greatest(upto, F.col(period)), F.expr(f"interval {step}"))))
    own = F.col("__p") == F.col(period)
    values = [F.when(own, F.col(f"`{c}`")).alias(c) for c in df.columns if c not in (*keys, period)]
    return rows.select(*keys, F.col("__p").alias(period), *values)


def last_valid_period(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Last period with a value, and the month after, which a live forecast is for."""
    last = F.max(F.when(F.col(value).isNotNull(), F.col(period)))
    return df.groupBy(*keys).agg(last.alias("last_period"), F.add_months(last, 1).alias("target_period"))


def join_offset(df: DataFrame, keys: Sequence[str], period: str, value: str, months: int = 0, days: int = 0, out: str = "offset_value") -> DataFrame:
    """Each row with the value so many months and days earlier: an equality join, so gaps stay gaps."""
    moved = F.date_add(F.add_months(period, months), days) if days else F.add_months(period, months)
    past = df.select(*keys, moved.alias(period), F.col(value).alias(out))
    return df.join(past, [*keys, period], "left")


def join_asof_last(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, when: str, value: str, max_age: int, tie: Sequence[str] = ()) -> DataFrame:
    """``left`` (keys, at) with the last value at or before ``at``, ``max_age`` days old at most.

    Both sides go into one sorted run per key and the value is carried forward: no range join, one shuffle.
    """
    marks = left.select(*keys, F.col(at).alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"))
    kind = marks.schema["__row"].dataType.simpleString()
    points = right.where(F.col(value).isNotNull()).select(
        *keys, F.col(when).alias("__t"), F.lit(0).alias("__side"), F.struct(F.col(when).alias("when"), F.col(value).alias("value")).alias("__point"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(tie)]
    )
    both = marks.withColumn("__point", F.lit(None).cast(points.schema["__point"].dataType)).unionByName(points.withColumn("__row", F.lit(None).cast(kind)), allowMissingColumns=True)
    run = Window.partitionBy(*keys).orderBy("__t", "__side", *[f"__o{i}" for i in range(len(tie))]).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__last", F.last("__point", ignorenulls=True).over(run)).where("__side = 1")
    fresh = F.datediff("__t", "__last.when") <= max_age
    return out.select("__row.*", F.when(fresh, F.col("__last.when")).alias("asof_when"), F.when(fresh, F.col("__last.value")).alias("asof_value"))


def asof_top_k(df: DataFrame, keys: Sequence[str], when: str, value: str, k: int) -> DataFrame:
    """Per key and month (from the first with a value to the last) the k most recent values up to the month's end, newest first, however
    far back they lie; null when there are fewer so far.

    Each value carries the k - 1 before it; the last of a month, or of the months before, is what the month sees.
    """
    run = Window.partitionBy(*keys).orderBy(when)
    known = df.where(F.col(value).isNotNull())
    top = F.array(*[F.lag(value, i).over(run) if i else F.col(value) for i in range(k)])
    rows = known.select(*keys, F.col(when).alias("__t"), F.trunc(when, "MM").alias("period"), top.alias("__top"), F.row_number().over(run).alias("__n"))
    last = rows.groupBy(*keys, "period").agg(F.max_by(F.when(F.col("__n") >= k, F.col("__top")), "__t").alias("__top"))
    months = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    out = densify(last, keys, "period").withColumn("__top", F.last("__top", ignorenulls=True).over(months))
    return out.select(*keys, "period", *[F.col("__top")[i].alias(f"v{i}") for i in range(k)])


def weeks_in_month(df: DataFrame, keys: Sequence[str], when: str, fallback: int = 4) -> DataFrame:
    """Per key and month (from the first to the last) how many different weeks end in it (on Saturday) of which something was observed;
    ``fallback`` for a month without any."""
    weeks = df.select(*keys, F.next_day(F.date_sub(when, 1), "SAT").alias("__w"))
    counts = weeks.groupBy(*keys, F.trunc("__w", "MM").alias("period")).agg(F.count_distinct("__w").alias("weeks"))
    return densify(counts, keys, "period").withColumn("weeks", F.coalesce("weeks", F.lit(fallback)))


def completeness(df: DataFrame, keys: Sequence[str], when: str, expected: Column) -> DataFrame:
    """Share of the expected days of a month that were observed, 1 at most."""
    seen = df.groupBy(*keys, F.trunc(when, "MM").alias("period")).agg(F.count_distinct(when).alias("__n"))
    return seen.select(*keys, "period", F.least(F.col("__n") / expected, F.lit(1.0)).alias("completeness"))


def published_or_mean(df: DataFrame, keys: Sequence[str], published: Column, value: Column, digits: int = 1) -> DataFrame:
    """The published row's value where there is one, else the rounded mean of the others. ``value`` is a whole number of hundredths, so
    sums don't depend on order."""
    own = F.max(F.when(published, value)) / 100.0
    rest = F.when(~published, value)
    return df.groupBy(*keys).agg(F.coalesce(own, F.bround(F.sum(rest).cast("double") / F.count(rest) / 100, digits)).alias("average"))


def ordered_first(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], out: str = "first") -> DataFrame:
    """The value of the last row in the order: an ordered array's first element, without the array."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(out))


def conditional_max(df: DataFrame, keys: Sequence[str], cases: Mapping[str, Column], value: Column) -> DataFrame:
    """One column per case: the largest value of the rows that it holds for."""
    return df.groupBy(*keys).agg(*[F.max(F.when(case, value)).alias(name) for name, case in cases.items()])


def pivot_wide(df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """One column for each named value of ``name``; the mapping renames."""
    wide = df.groupBy(*keys).pivot(name, list(columns)).agg(F.first(value))
    return wide.withColumnsRenamed(dict(columns))


def intersect_origins(df: DataFrame, origin: Sequence[str], method: str, methods: int) -> DataFrame:
    """Rows of the origins that all methods predicted."""
    common = df.groupBy(*origin).agg(F.count_distinct(method).alias("__n")).where(F.col("__n") == methods).drop("__n")
    return df.join(common, list(origin), "left_semi")


def complete_month_mean(df: DataFrame, keys: Sequence[str], day: str, value: str, gap: int) -> DataFrame:
    """Monthly means; null unless the first day is within ``gap`` of the start and the last within gap - 1 of the end."""
    out = df.groupBy(*keys, F.trunc(day, "MM").alias("period")).agg(F.avg(value).alias("mean"), F.min(day).alias("__a"), F.max(day).alias("__b"))
    whole = (F.dayofmonth("__a") <= gap) & (F.datediff(F.last_day("period"), F.col("__b")) <= gap - 1)
    return out.select(*keys, "period", F.when(whole, F.col("mean")).alias("mean"))


def month_window_mean(df: DataFrame, keys: Sequence[str], day: str, value: Column, low: int, high: int) -> DataFrame:
    rows = df.where(F.dayofmonth(day).between(low, high))
    return rows.groupBy(*keys, F.trunc(day, "MM").alias("period")).agg(value.alias("mean"))


def survey_window_mean(df: DataFrame, keys: Sequence[str], day: str, value: Column, start: int = 25, end: int = 7) -> DataFrame:
    """Mean from day ``start`` of the month before to day ``end`` of the month; a row may fall into two months."""
    month = F.trunc(day, "MM")
    own = F.when(F.dayofmonth(day) <= end, month)
    following = F.when(F.dayofmonth(day) >= start, F.add_months(month, 1))
    rows = df.withColumn("period", F.explode(F.array_compact(F.array(own, following))))
    return rows.groupBy(*keys, "period").agg(value.alias("mean"))


def week_label(day: Column, weekday: str = "MON") -> Column:
    """The next such weekday at or after the day: weeks end on it and are labelled by it."""
    return F.next_day(F.date_sub(day, 1), weekday)


def component_sum(df: DataFrame, keys: Sequence[str], name: str, value: str, parts: Sequence[str], out: str = "total") -> DataFrame:
    """Sum of named components, null if one is missing."""
    wide = df.groupBy(*keys).pivot(name, list(parts)).agg(F.first(value))
    total = F.col(f"`{parts[0]}`")
    for p in parts[1:]:
        total = total + F.col(f"`{p}`")
    return wide.select(*keys, total.alias(out))


def snapshot_sizes(df: DataFrame, day: str, value: Column, least: int = 3) -> DataFrame:
    """Per day its number of members' rows and their sum, days with fewer than ``least`` left out; combined before the shuffle, so a day
    of any size will do."""
    return df.groupBy(day).agg(F.count("*").alias("n"), F.sum(value).alias("total")).where(F.col("n") >= least)


def collect_snapshot(df: DataFrame, day: str, columns: Sequence[str], least: int = 3, most: int = 10_000) -> DataFrame:
    """Per day the ordered list of members' rows, days with fewer than ``least`` left out. A list of more than ``most`` rows is refused with
    an error before any is made: ``snapshot_sizes`` and plain aggregates serve such days."""
    sizes = df.groupBy(day).agg(F.count("*").alias("__n"))
    largest = sizes.agg(F.max("__n")).first()[0] or 0
    if largest > most:
        raise ValueError(f"a day has {largest} rows, over {most}")
    kept = df.join(sizes.where(F.col("__n") >= least), day, "left_semi")
    return kept.groupBy(day).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("members"))


def first_seen(df: DataFrame, keys: Sequence[str], observed: str, released: Column) -> DataFrame:
    """Per key the first observation, and the first release date that is known."""
    first_release = F.min_by(released, F.struct(F.when(released.isNotNull(), 0).otherwise(1), F.col(observed)))
    return df.groupBy(*keys).agg(F.min(observed).alias("first_seen"), first_release.alias("released"))
