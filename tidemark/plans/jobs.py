"""Prebuilt forecasts as declarative specs: inputs, transforms, columns and the least training rows, all fed to one engine.

A spec names its inputs; a caller maps them to columns of a panel, one row per series and month without gaps. Each regressor says at
which lag it may be used, and the engine refuses a spec whose regressors are not published before the target. Inputs that are
means or picks of daily data within a month come from ``daily_windows``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import month_dummies, reference_week_tuesday, row_mean
from tidemark.operators import reshape as R
from tidemark.operators.features import Series
from tidemark.operators.walkforward import wf_ols


@dataclass(frozen=True)
class Term:
    """One regressor: a transform of an input (or of two, for gaps) at a lag. An input of several names is the mean of those known."""

    name: str
    input: str
    transform: str = "dlog"
    lag: int = 0
    other: str | None = None

    @property
    def inputs(self) -> list[str]:
        return [x for x in (*self.input.split("+"), self.other) if x]


@dataclass(frozen=True)
class JobSpec:
    name: str
    target: str
    target_transform: str
    terms: tuple[Term, ...]
    min_train: int
    #: Least lag at which an input is known when the target's forecast is made; 0: published earlier in the month.
    available_lag: Mapping[str, int] = field(default_factory=dict)
    #: The other input of a target that is a gap.
    target_other: str | None = None

    def check(self) -> None:
        for t in self.terms:
            for name in t.inputs:
                least = self.available_lag.get(name, 1 if name == self.target else 0)
                # seasonal means and gaps to the print before look back by themselves
                if t.lag < least and t.transform not in BACKWARD:
                    raise ValueError(f"{self.name}: {t.name} uses {name} at lag {t.lag}, known from lag {least}")

    def inputs(self) -> list[str]:
        return list(dict.fromkeys(x for x in (self.target, self.target_other, *[x for t in self.terms for x in t.inputs]) if x))


BACKWARD = ("seasonal", "seasonal_gap", "gap_to_prior", "log_gap_to_prior")


def transformed(s: Series, kind: str, x: Column, other: Column | None = None, y: Column | None = None) -> Column:
    """``x`` (and ``other``) as a regressor or target; ``y`` is the target where a transform refers to it."""
    simple = {
        "level": lambda: x,
        "log": lambda: F.ln(x),
        "diff": lambda: s.diff(x),
        "dlog": lambda: s.dlog(x),
        "pct": lambda: s.pct_change(x),
        "yoy_log": lambda: s.dlog(x, 12),
        "centred": lambda: (x - 50) / 100,
        "shortfall": lambda: 50 - x,
        "deviation": lambda: s.deviation(x),
        "gap": lambda: x - other,
        "log_gap": lambda: F.ln(x) - F.ln(other),
        "pct_of": lambda: (x / other - 1) * 100,
        "gap_to_prior": lambda: x - s.lag(other),
        "log_gap_to_prior": lambda: F.ln(x) - s.lag(F.ln(other)),
        "seasonal": lambda: s.seasonal_mean(y),
        "seasonal_gap": lambda: s.seasonal_mean(y - F.col("__dlog")),
    }
    if kind not in simple:
        raise ValueError(kind)
    return simple[kind]()


def build_features(panel: DataFrame, spec: JobSpec, keys: list[str], period: str) -> DataFrame:
    """The panel with ``y`` and a column for each term."""
    spec.check()
    s = Series(keys, period)
    column = lambda name: F.col(name) if "+" not in name else row_mean([F.col(x) for x in name.split("+")])
    other = lambda name: F.col(name) if name else None
    out = panel.withColumn("y", transformed(s, spec.target_transform, F.col(spec.target), other(spec.target_other)))
    for t in spec.terms:
        if t.transform == "month_dummies":
            out = out.withColumns({f"m_{i}": c for i, c in enumerate(month_dummies(F.col(period)), start=2)})
            continue
        if t.transform == "seasonal_gap":
            out = out.withColumn("__dlog", s.dlog(column(t.input)))
        x = transformed(s, t.transform, column(t.input) if t.input else None, other(t.other), F.col("y"))
        out = out.withColumn(f"__{t.name}", x).withColumn(t.name, s.lag(F.col(f"__{t.name}"), t.lag) if t.lag else F.col(f"__{t.name}"))
    return out.drop("__dlog", *[f"__{t.name}" for t in spec.terms])


def feature_names(terms: Sequence[Term]) -> list[str]:
    return [name for t in terms for name in ([f"m_{i}" for i in range(2, 13)] if t.transform == "month_dummies" else [t.name])]


def level_of(s: Series, spec: JobSpec, prediction: Column) -> Column:
    """The target's level that a prediction of its transform implies."""
    x = F.col(spec.target)
    before = s.lag(x)
    other = F.col(spec.target_other) if spec.target_other else None
    return {
        "dlog": lambda: before * F.exp(prediction),
        "pct": lambda: before * (1 + prediction / 100),
        "diff": lambda: before + prediction,
        "level": lambda: prediction,
        "log": lambda: F.exp(prediction),
        "gap": lambda: other + prediction,
        "gap_to_prior": lambda: s.lag(other) + prediction,
    }[spec.target_transform]()


def run_job(panel: DataFrame, spec: JobSpec, keys: list[str], period: str, min_train: int | None = None) -> DataFrame:
    """keys, period, y, n_train, prediction, and the level that the prediction implies."""
    rows = build_features(panel, spec, keys, period)
    out = wf_ols(rows, keys, period, "y", feature_names(spec.terms), spec.min_train if min_train is None else min_train)
    return out.withColumn("level", level_of(Series(keys, period), spec, F.col("prediction"))).select(*keys, period, "y", "n_train", "prediction", "level")


@dataclass(frozen=True)
class Member:
    """One of an ensemble's ridge fits: its terms and penalty."""

    name: str
    terms: tuple[Term, ...]
    ridge: float


@dataclass(frozen=True)
class EnsembleSpec:
    """Ridge fits of the target's logarithm, averaged where they exist; the fallback serves where none does."""

    name: str
    target: str
    members: tuple[Member, ...]
    fallback: Member
    min_train: int

    def inputs(self) -> list[str]:
        return list(dict.fromkeys([self.target, *[x for m in (*self.members, self.fallback) for t in m.terms for x in t.inputs]]))


def run_ensemble(panel: DataFrame, spec: EnsembleSpec, keys: list[str], period: str, min_train: int | None = None) -> DataFrame:
    """keys, period, y, n_train (the least of the fits used), method, prediction (of the logarithm), level."""
    every = tuple({t.name: t for m in (*spec.members, spec.fallback) for t in m.terms}.values())
    rows = build_features(panel, JobSpec(spec.name, spec.target, "log", every, spec.min_train), keys, period)
    least = spec.min_train if min_train is None else min_train
    for m in (*spec.members, spec.fallback):
        rows = wf_ols(rows, keys, period, "y", feature_names(m.terms), least, ridge=m.ridge, out=m.name).withColumnRenamed("n_train", f"__n_{m.name}")
    names = [m.name for m in spec.members]
    known = [F.col(n).isNotNull() for n in names]
    mean = row_mean([F.col(n) for n in names])
    some, every_one = known[0], known[0]
    for k in known[1:]:
        some, every_one = some | k, every_one & k
    method = F.when(every_one, "ensemble")
    for n, k in zip(names, known, strict=True):
        method = method.when(k, f"{n}_only")
    method = method.when(F.col(spec.fallback.name).isNotNull(), "fallback")
    used = F.array_compact(F.array(*[F.when(k, F.col(f"__n_{n}")) for n, k in zip(names, known, strict=True)]))
    out = rows.withColumns(
        {
            "method": method,
            "prediction": F.when(some, mean).otherwise(F.col(spec.fallback.name)),
            "n_train": F.when(some, F.array_min(used)).otherwise(F.col(f"__n_{spec.fallback.name}")),
        }
    )
    return out.select(*keys, period, "y", "n_train", "method", "prediction", F.exp("prediction").alias("level"))


def daily_windows(df: DataFrame, keys: list[str], day: str, value: str, name: str, late: tuple[int, int] = (8, 21)) -> DataFrame:
    """Monthly inputs from daily data: keys, period, ``name``_mid (the last value at or up to six days before the Tuesday of the week
    that holds the 13th), ``name``_sw (mean from the 25th of the month before to the 7th) and ``name``_late (mean of ``late``)."""
    known = df.where(F.col(value).isNotNull())
    months = known.select(*keys, F.trunc(day, "MM").alias("period")).distinct()
    at = months.withColumn("__at", reference_week_tuesday(F.col("period")))
    mid = R.join_asof_last(at, known, keys, "__at", day, value, 6).select(*keys, "period", F.col("asof_value").alias(f"{name}_mid"))
    survey = R.survey_window_mean(known, keys, day, F.avg(value)).withColumnRenamed("mean", f"{name}_sw")
    after = R.month_window_mean(known, keys, day, F.avg(value), *late).withColumnRenamed("mean", f"{name}_late")
    return mid.join(survey, [*keys, "period"], "left").join(after, [*keys, "period"], "left")


def _lags(name: str, source: str, lags, transform: str = "dlog") -> tuple[Term, ...]:
    return tuple(Term(f"{name}_{k}", source, transform, k) for k in lags)


_SEASON = Term("seas", "", "seasonal")
#: Columns and least training rows of the jobs.
SPECS = {
    s.name: s
    for s in (
        JobSpec("eggs_job", "ap", "dlog", (*_lags("dap", "ap", [1]), *_lags("dppi", "ppi", [1, 2, 3]), _SEASON), 96),
        JobSpec("gasoline_job", "cpi", "dlog", (Term("eia_mm", "eia"), Term("wedge", "eia", "seasonal_gap")), 96),
        JobSpec("electricity_job", "ap", "dlog", (*_lags("dap", "ap", [1, 12]), _SEASON), 96),
        JobSpec("airfares_job", "ap", "dlog", (*_lags("dap", "ap", [1, 2]), *_lags("dwti", "wti", [0, 1, 2])), 96),
        JobSpec("ppi_job", "nsa", "dlog", (*_lags("dgas_mid", "gas_mid", [0]), *_lags("ddiesel_mid", "diesel_mid", [0]), *_lags("ismm", "ism", [0], "centred"), _SEASON, *_lags("dsa", "sa", [1])), 72),
        JobSpec("pce_job", "pce", "dlog", (*_lags("dccpi", "ccpi", [0]), *_lags("dair", "air", [0])), 96),
        JobSpec("retail_job", "rs", "dlog", (*_lags("dgas", "gas", [0]), *_lags("drs", "rs", [1, 2])), 96),
        JobSpec("ism_job", "pmi", "diff", (Term("fl_gap", "flash", "gap_to_prior", 0, "pmi"), Term("fed_gap", "empire+philly+richmond+dallas", "gap_to_prior", 0, "pmi"), *_lags("dpmi", "pmi", [1], "diff")), 60),
        JobSpec("construction_job", "starts", "dlog", (Term("gap_1", "permits", "log_gap", 1, "starts"), *_lags("dst", "starts", [1]), *_lags("dhmi", "hmi", [0], "diff"), *_lags("tdev", "tavg", [0, 1], "deviation")), 120),
        JobSpec("permits_job", "permits", "dlog", (*_lags("dsfpm", "single", [1]), *_lags("dmfpm", "multi", [1])), 120),
        JobSpec("home_sales_job", "sales", "dlog", (*_lags("dperm", "permits", [0]), Term("perm_gap", "permits", "log_gap_to_prior", 0, "sales"), *_lags("dnhs", "sales", [1])), 120),
        JobSpec("sentiment_job", "prelim", "gap_to_prior", (Term("dgas_sw", "gas_sw", "pct"), Term("dsp_sw", "sp_sw", "pct")), 96, target_other="final"),
        JobSpec("sentiment_final_job", "final", "gap", (Term("dgas_sw_post", "gas_late", "pct_of", 0, "gas_sw"), Term("dsp_sw_post", "sp_late", "pct_of", 0, "sp_sw")), 96, target_other="prelim"),
    )
}
_BASE = (Term("ly_l1", "cuts", "log", 1), Term("months", "", "month_dummies"))
_ISM = Term("ism_dev", "ism_emp", "shortfall")
#: Members, penalties and least training rows of the ridge ensemble.
ENSEMBLES = {
    "challenger_job": EnsembleSpec(
        "challenger_job",
        "cuts",
        (
            Member("ism", (*_BASE, _ISM), 5.0),
            Member("allind", (*_BASE, _ISM, Term("claims_yoy", "claims", "yoy_log"), Term("cb_labor_differential", "cb", "level"), Term("mich", "mich", "level")), 15.0),
        ),
        Member("base", _BASE, 1e-6),
        48,
    )
}
