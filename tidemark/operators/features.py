"""Point-in-time features. Frames count rows, so series are densified first; every window is partitioned by series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


class Series:
    """Feature columns of one series key and order. Columns of the same key share one sort."""

    def __init__(self, keys: Sequence[str], period: str):
        self.keys, self.period = list(keys), period

    @property
    def run(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.period)

    def before(self, n: int | None = None) -> WindowSpec:
        return self.run.rowsBetween(Window.unboundedPreceding if n is None else -n, -1)

    def upto(self, n: int | None = None) -> WindowSpec:
        return self.run.rowsBetween(Window.unboundedPreceding if n is None else -n, 0)

    def lag(self, x: Column, k: int = 1) -> Column:
        return F.lag(x, k).over(self.run)

    def lead(self, x: Column, k: int = 1) -> Column:
        return F.lead(x, k).over(self.run)

    def diff(self, x: Column, k: int = 1) -> Column:
        return x - self.lag(x, k)

    def dlog(self, x: Column, k: int = 1) -> Column:
        return F.ln(x) - F.ln(self.lag(x, k))

    def pct_change(self, x: Column, k: int = 1) -> Column:
        """Percent; gaps are not filled first."""
        return (x / self.lag(x, k) - 1) * 100

    def rolling_mean(self, x: Column, n: int, least: int, current: bool = False) -> Column:
        frame = self.upto(n - 1) if current else self.before(n)
        return F.when(F.count(x).over(frame) >= least, F.avg(x).over(frame))

    def expanding_mean(self, x: Column) -> Column:
        return F.avg(x).over(self.before())

    def seasonal_mean(self, x: Column) -> Column:
        """Mean of the same calendar month in the years before."""
        same = Window.partitionBy(*self.keys, F.month(self.period)).orderBy(self.period)
        return F.avg(x).over(same.rowsBetween(Window.unboundedPreceding, -1))

    def deviation(self, x: Column) -> Column:
        return x - self.seasonal_mean(x)

    def ffill(self, x: Column, limit: int | None = None) -> Column:
        return F.last(x, ignorenulls=True).over(self.upto(limit))

    def gap_aware_diff(self, x: Column, longest: int = 1) -> Column:
        """Change a day, where the row before is at most ``longest`` days back."""
        gap = F.datediff(F.col(self.period), self.lag(F.col(self.period)))
        return F.when(gap <= longest, (x - self.lag(x)) / gap)

    def cointegration_gap(self, a: Column, b: Column) -> Column:
        return self.lag(F.ln(a) - F.ln(b))

    def zscore(self, x: Column, point_in_time: bool = False) -> Column:
        """By the population's deviation; over all rows, or over those before."""
        frame = self.before() if point_in_time else self.run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return F.try_divide(x - F.avg(x).over(frame), F.stddev_pop(x).over(frame))

    def direction_label(self, x: Column) -> Column:
        after = self.lead(x)
        return F.when(after.isNotNull() & x.isNotNull(), (after > x).cast("int"))

    def last_values(self, df: DataFrame, x: Column, n: int, out: str = "last") -> DataFrame:
        """``df`` with the last n known values strictly before each row, newest first; null when there are fewer. A row hands on its
        value and those it was handed, so n values are carried, not the whole past."""
        names, before = [f"__v{i}" for i in range(n)], self.before()
        df = df.withColumn("__x", x)
        for i, name in enumerate(names):
            handed = F.col("__x") if i == 0 else F.when(F.col("__x").isNotNull(), F.col(names[i - 1]))
            # a known value without predecessors hands on nothing, not what an earlier row was handed
            marked = F.when(F.col("__x").isNotNull(), F.struct(handed.alias("v")))
            df = df.withColumn(name, F.last(marked, ignorenulls=True).over(before)["v"])
        full = F.when(F.col(names[-1]).isNotNull(), F.array(*names))
        return df.withColumn(out, full).drop("__x", *names)

    def local_drift(self, x: Column, nearest: int = 5, furthest: int = 14) -> Column:
        """Slope a row to the furthest known value 14 to 5 rows back."""
        options = [F.when(self.lag(x, k).isNotNull(), (x - self.lag(x, k)) / k) for k in range(furthest, nearest - 1, -1)]
        return F.coalesce(*options)

    def freshest_lag(self, x: Column, lags: Sequence[int], required: bool = False) -> Column:
        """The least lag at which the value and the one before it are known; null, or an error if it is required, where there is none."""
        options = [F.when(self.lag(x, k).isNotNull() & self.lag(x, k + 1).isNotNull(), F.lit(k)) for k in lags]
        none = F.concat(F.lit(f"no lag of {list(lags)} is known at "), F.col(self.period).cast("string"))
        return F.coalesce(*options, F.raise_error(none).cast("int")) if required else F.coalesce(*options)


def price_updated_weights(df: DataFrame, group: str, period: str, index: str, weight: str, base: str) -> DataFrame:
    """Weights of the base period moved by each component's index up to the period before, as shares of the group's sum."""
    base_rows = df.where(F.col(period) == F.lit(base).cast("date")).select(group, F.col(index).alias("__base"))
    run = Window.partitionBy(group).orderBy(period)
    moved = df.join(base_rows, group).withColumn("__w", F.col(weight) * F.lag(index).over(run) / F.col("__base"))
    return moved.withColumn("share", F.col("__w") / F.sum("__w").over(Window.partitionBy(period))).drop("__base", "__w")


def renewal_hazard(df: DataFrame, member: str, when: str) -> DataFrame:
    """P(gap = k | gap >= k) per member for each k up to the longest gap, 0 where no gap is k."""
    run = Window.partitionBy(member).orderBy(when)
    gaps = df.select(member, when).distinct().withColumn("gap", F.datediff(F.col(when), F.lag(when).over(run))).where("gap is not null")
    counts = gaps.groupBy(member, "gap").agg(F.count("*").alias("n"))
    grid = counts.groupBy(member).agg(F.max("gap").alias("__m")).select(member, F.explode(F.sequence(F.lit(1), "__m")).alias("gap"))
    whole = grid.join(counts, [member, "gap"], "left").fillna(0, ["n"])
    over = Window.partitionBy(member).orderBy(F.desc("gap")).rowsBetween(Window.unboundedPreceding, 0)
    return whole.withColumn("at_risk", F.sum("n").over(over)).withColumn("hazard", F.col("n") / F.col("at_risk"))


def weekday_factor(df: DataFrame, when: str, smoothing: float = 1.0, cap: float = 2.0) -> DataFrame:
    """Share of each weekday (Monday 0) over an even share, smoothed and capped."""
    counts = df.groupBy(F.weekday(when).alias("weekday")).agg(F.count("*").alias("n"))
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    rows = days.join(F.broadcast(counts), "weekday", "left").fillna(0, ["n"])
    total = rows.agg(F.sum("n").alias("total"))
    share = (F.col("n") + smoothing) / (F.col("total") + 7 * smoothing)
    return rows.join(F.broadcast(total)).select("weekday", "n", F.least(share * 7, F.lit(cap)).alias("factor"))


def member_offsets(df: DataFrame, truth: DataFrame, member: str, day: str, value: str, true_value: str, floor: float = 0.3, least: int = 5, fallback: float = 1.0) -> DataFrame:
    """Mean of value - truth per member, its number of rows, and one residual deviation for all: the population deviation of what is left
    once each member's mean is taken off, ``floor`` at least, and ``fallback`` with ``least`` residuals or fewer."""
    rows = df.join(truth, day).select(member, (F.col(value) - F.col(true_value)).alias("__e")).where("__e IS NOT NULL")
    per = rows.groupBy(member).agg(F.avg("__e").alias("offset"), F.count("*").alias("n"), F.sum(F.col("__e") * F.col("__e")).alias("__ee"))
    pooled = per.agg(F.sum("n").alias("__n"), F.sum(F.col("__ee") - F.col("n") * F.col("offset") * F.col("offset")).alias("__left"))
    sd = F.when(F.col("__n") > least, F.greatest(F.sqrt(F.greatest(F.col("__left"), F.lit(0.0)) / F.col("__n")), F.lit(floor))).otherwise(F.lit(fallback))
    return per.join(F.broadcast(pooled)).select(member, "offset", sd.alias("residual_sd"), "n")


def active_members(df: DataFrame, member: str, when: str, today: str, factor: float = 3.0, most: float = 50.0) -> DataFrame:
    """Members idle no longer than ``factor`` times their median gap, ``most`` days at most."""
    run = Window.partitionBy(member).orderBy(when)
    days = df.select(member, when).distinct().withColumn("gap", F.datediff(F.col(when), F.lag(when).over(run)))
    idle = F.datediff(F.lit(today).cast("date"), F.max(when))
    out = days.groupBy(member).agg(F.median("gap").alias("median_gap"), idle.alias("idle"))
    return out.where(F.col("idle") <= F.least(F.col("median_gap") * factor, F.lit(most)))
