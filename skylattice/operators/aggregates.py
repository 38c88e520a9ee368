"""Aggregations of tables, grids and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import correlation, decade, season
from ..ordered import OrderedRows, attach, exact_quantiles, join_null_safe, quantile_columns


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_by_month_hour(df: DataFrame, ts: str, label: str) -> DataFrame:
    """Counts of each label by month and by hour, in one pass over the data."""
    # first to at most 12 x 24 rows per label, then to the two tables
    fine = df.groupBy(label, F.month(ts).alias("month"), F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    at = [F.struct(F.lit(p).alias("part"), F.col(p).alias("at")) for p in ("month", "hour")]
    return fine.select(label, "n", F.inline(F.array(*at))).groupBy(label, "part", "at").agg(F.sum("n").alias("n"))


def mean_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(v).alias(f"mean_{v}") for v in values])


def mean_std_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation."""
    aggs = []
    for v in values:
        aggs += [F.avg(v).alias(f"mean_{v}"), F.stddev_samp(v).alias(f"std_{v}")]
    return df.groupBy(*keys).agg(*aggs)


def frequent_top(df: DataFrame, key: str, value: str, more_than: int, top: int) -> DataFrame:
    """The ``top`` keys by mean value among keys with enough rows; ties by key."""
    stats = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
    return stats.where(F.col("n") > more_than).orderBy(F.desc("mean_value"), F.asc(key)).limit(top)


def describe(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max, global or by group."""
    base = df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quart = quantile_columns(df, list(keys), value, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    if keys:
        out = join_null_safe(base, quart, list(keys))
    else:
        three = quart.select(F.struct("p25", "p50", "p75").alias("q")).scalar()
        out = base.withColumn("q", three).select("*", "q.*")
    return out.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with and without a value, one row per column."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__some"), F.count_if(F.col(c).isNull()).alias(f"{c}__none")]
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__some").alias("n_value"), F.col(f"{c}__none").alias("n_null"))
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])


def row_mean(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Mean over columns within a row, nulls left out; null if all are null."""
    total: Column = F.lit(0.0)
    n: Column = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        n = n + F.col(c).isNotNull().cast("int")
    return df.withColumn(out, F.when(n > 0, total / n))


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed.

    With ``keys`` each group has its own range. Empty bins are listed too.
    """
    keys = list(keys)
    ends = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where(F.col("lo").isNotNull())
    width = (F.col("hi") - F.col("lo")) / bins
    if keys:
        ranged = attach(df.where(F.col(value).isNotNull()), ends, keys, "inner")
    else:
        lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
        ranged = df.where(F.col(value).isNotNull()).withColumn("lo", lo).withColumn("hi", hi)
    place = F.when(width > 0, F.floor((F.col(value) - F.col("lo")) / width)).otherwise(F.lit(0))
    counts = (
        ranged.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return join_null_safe(frame, counts, [*keys, "bin"]).select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def histogram_2d(df: DataFrame, x: str, y: str, x_range, dx: float, y_range, dy: float) -> DataFrame:
    """Counts per cell of a 2-d histogram.

    A value falls in cell ``ceil((v - start) / width)``, held to the axis, so
    cell 0 takes everything at or below the start of the axis.
    """

    def cell(v: str, rng, d: float) -> Column:
        last = int((rng[1] - rng[0]) / d) + 1
        at = F.ceil((F.col(v) - F.lit(float(rng[0]))) / F.lit(float(d)))
        return F.least(F.greatest(at, F.lit(0)), F.lit(last)).cast("int")

    return df.groupBy(cell(x, x_range, dx).alias("x_bin"), cell(y, y_range, dy).alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def linear_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


# statistics a grid can be collapsed with
COLLAPSE = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "std": F.stddev_samp,
}


def collapse(df: DataFrame, keep: Sequence[str], value: str, statistics: Sequence[str]) -> DataFrame:
    """Collapse all dimensions that are not kept."""
    return df.groupBy(*keep).agg(*[COLLAPSE[s](value).alias(s) for s in statistics])


def aggregate_by_season(df: DataFrame, ts: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, season(F.month(ts)).alias("season")).agg(
        F.avg(value).alias("mean"), F.count(value).alias("n")
    )


def aggregate_by_decade(df: DataFrame, ts: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, decade(F.year(ts)).alias("decade")).agg(
        F.avg(value).alias("mean"), F.count(value).alias("n")
    )


def collapsed_difference(a: DataFrame, b: DataFrame, keep: Sequence[str], value: str) -> DataFrame:
    """Mean of each scenario over all other dimensions, then ``a - b``."""
    left = a.groupBy(*keep).agg(F.avg(value).alias("mean_a"))
    right = b.groupBy(*keep).agg(F.avg(value).alias("mean_b"))
    return left.join(right, list(keep)).withColumn("difference", F.col("mean_a") - F.col("mean_b"))


def level_statistics(df: DataFrame, level: str, features: Sequence[str], ddof: int = 0) -> DataFrame:
    """Mean and std per feature and level, and per feature over all levels.

    One pass over the data gives a row of moments per level; the rows for all
    levels (level null) are put together from those.
    """
    moments = []
    for f in features:
        v = F.col(f).cast("double")
        moments.append(F.struct(F.lit(f).alias("feature"), F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v")))
    rows = df.groupBy(level).agg(F.array(*moments).alias("__m")).select(level, F.inline("__m")).where(F.col("n") > 0)
    n, m = F.col("n"), F.col("m")
    whole = rows.groupBy("feature").agg(
        F.sum("n").alias("n"), (F.sum(n * m) / F.sum("n")).alias("m"), F.sum(n * (F.col("v") + m * m)).alias("s")
    )
    whole = whole.select(
        F.lit(None).cast(df.schema[level].dataType).alias(level),
        "feature",
        "n",
        "m",
        F.greatest(F.col("s") / n - m * m, F.lit(0.0)).alias("v"),
    )
    var = F.col("v") if ddof == 0 else F.try_divide(F.col("v") * n, n - 1)
    return rows.unionByName(whole).select("feature", level, m.alias("mean"), F.sqrt(var).alias("std"))


def level_min_max(df: DataFrame, level: str, value: str, earlier: DataFrame | None = None) -> DataFrame:
    """Smallest and largest value per level, merged with an earlier result."""
    now = df.groupBy(level).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    if earlier is None:
        return now
    both = now.unionByName(earlier.select(level, "lo", "hi"))
    return both.groupBy(level).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one aggregation."""
    aggs, rows = [], []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            name = f"c_{min(i, j)}_{max(i, j)}"
            if i <= j:
                aggs.append(correlation(a, b).alias(name))
            rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(name).alias("r")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def first_level_above(df: DataFrame, sample: Sequence[str], level: str, value: str, threshold: float, top: int) -> DataFrame:
    """First level strictly above the threshold; ``top`` where there is none."""
    hit = F.min(F.when(F.col(value) > threshold, F.col(level)))
    return df.groupBy(*sample).agg(F.coalesce(hit, F.lit(top)).cast("int").alias("base"))


def first_index_above(profile: Column, threshold: float, top: int) -> Column:
    """The same for a profile held in an array column."""
    at = F.array_position(F.transform(profile, lambda v: F.coalesce(v > threshold, F.lit(False))), F.lit(True))
    return F.when(at > 0, at - 1).otherwise(F.lit(top)).cast("int")


def index_of_max(profile: Column) -> Column:
    """0-based index of the largest element, the first one on ties."""
    return (F.array_position(profile, F.array_max(profile)) - 1).cast("int")


def event_share(df: DataFrame, condition: Column, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(condition.cast("double")).alias("share_with"),
        F.avg((~condition).cast("double")).alias("share_without"),
    )


def trapezoid(df: DataFrame, group: Sequence[str], x: str, y: str, tie: Sequence[str] = ()) -> DataFrame:
    """Integral of y over x by trapezoids, per group."""
    rows = OrderedRows(df, group, [x, *tie]).previous({x: "__px", y: "__py"}).finish()
    area = (F.col(x) - F.col("__px")) * (F.col(y) + F.col("__py")) / 2
    return rows.groupBy(*group).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("integral"))


def quantile(df: DataFrame, value: str, prob: float, keys: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Quantile, exact with linear interpolation unless ``approximate``."""
    if approximate:
        return df.groupBy(*keys).agg(F.percentile_approx(value, prob, 10_000).alias("quantile"))
    return exact_quantiles(df, list(keys), value, [prob]).drop("prob")


def percentile_band(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """2.5 %, 95 % and 97.5 % quantiles and the maximum."""
    q = quantile_columns(df, keys, value, {"p025": 0.025, "p95": 0.95, "p975": 0.975})
    top = df.groupBy(*keys).agg(F.max(value).alias("max"))
    return join_null_safe(q, top, list(keys))


def mean_band(df: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    """Mean with one sample standard deviation below and above."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return stats.withColumn("lower", F.col("mean") - F.col("std")).withColumn("upper", F.col("mean") + F.col("std"))


def complete_groups(df: DataFrame, group: Sequence[str], member: str, n: int) -> DataFrame:
    """Rows of the groups in which ``n`` different members report."""
    full = df.groupBy(*group).agg(F.count_distinct(member).alias("__n")).where(F.col("__n") == n)
    return df.join(full.select(*group), list(group), "left_semi")


def collect_members(
    df: DataFrame, group: Sequence[str], member: str, members: Sequence, values: Sequence[str]
) -> DataFrame:
    """One row per group with a list per column, in the order of ``members``.

    ``df`` has one row per (group, member). A list has one place per member,
    so its length is fixed by the member list, not by the data; a group with
    none of the members stays, with nulls in its lists.
    """
    ids = F.array(*[F.lit(m) for m in members])
    aggs = []
    for v in values:
        places = [F.max(F.when(F.col(member) == F.lit(m), F.col(v))) for m in members]
        aggs.append(F.array(*places).alias(v))
    return df.groupBy(*group).agg(*aggs).withColumn(member, ids)
