"""Forecast verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import verification as ops
from .catalog import Tables, query, rounded
from .derived import FIELDS_SQL, model_fields


def _event(column: str):
    return F.col(column) == 1


@query(
    "mt_category",
    """SELECT doc_id, quality = 1 AND toxic = 1 AS "truePositive", quality = 0 AND toxic = 1 AS "falsePositive",
              quality = 0 AND toxic = 0 AS "trueNegative", quality = 1 AND toxic = 0 AS "falseNegative",
              CASE WHEN quality = 1 AND toxic = 1 THEN 'truePositive' WHEN quality = 0 AND toxic = 1 THEN 'falsePositive'
                   WHEN quality = 1 AND toxic = 0 THEN 'falseNegative' ELSE 'trueNegative' END AS result_category FROM labels""",
)
def mt_category(t: Tables):
    return ops.with_category(t.labels, "quality", "toxic").drop("quality", "toxic")


@query(
    "mt_confusion",
    """SELECT quality AS observed, toxic AS forecast, n, round(n / sum(n) OVER (PARTITION BY quality), 4) AS share
       FROM (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2)""",
)
def mt_confusion(t: Tables):
    return rounded(ops.confusion(t.labels, "quality", "toxic"))


@query(
    "mt_prf",
    """WITH k AS (SELECT unnest([0, 1]) AS label),
            s AS (SELECT label, count_if(toxic = label) AS n_fcst, count_if(quality = label) AS n_obs,
                         count_if(toxic = label AND quality = label) AS n_hit FROM labels, k GROUP BY 1)
       SELECT label, round(n_hit / n_fcst, 4) AS precision, round(n_hit / n_obs, 4) AS recall,
              round(2.0 * n_hit / (n_fcst + n_obs), 4) AS f1, n_obs::BIGINT AS support FROM s""",
)
def mt_prf(t: Tables):
    return rounded(ops.precision_recall(t.labels, "quality", "toxic"))


_TABLE = """c AS (SELECT count_if(quality = 1 AND toxic = 1)::BIGINT AS tp, count_if(quality = 0 AND toxic = 1)::BIGINT AS fp,
  count_if(quality = 1 AND toxic = 0)::BIGINT AS fn, count_if(quality = 0 AND toxic = 0)::BIGINT AS tn FROM labels)"""


@query("mt_hit_far", f"WITH {_TABLE} SELECT *, round(tp / (tp + fn), 4) AS hit_rate, round(fp / (fp + tn), 4) AS false_alarm_rate FROM c")
def mt_hit_far(t: Tables):
    return rounded(ops.hit_and_false_alarm(t.labels, _event("quality"), _event("toxic")))


@query("mt_balanced_acc", f"WITH {_TABLE} SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 4) AS balanced_accuracy FROM c")
def mt_balanced_acc(t: Tables):
    return rounded(ops.balanced_accuracy(t.labels, "quality", "toxic"))


@query(
    "mt_sedi",
    f"""WITH {_TABLE}, r AS (SELECT tp / (tp + fn) AS h, fp / (fp + tn) AS f FROM c)
        SELECT round((ln(f) - ln(h) - ln(1 - f) + ln(1 - h)) / (ln(f) + ln(h) + ln(1 - f) + ln(1 - h)), 4) AS sedi FROM r""",
)
def mt_sedi(t: Tables):
    rates = ops.hit_and_false_alarm(t.labels, _event("quality"), _event("toxic"))
    return rounded(rates.select(ops.sedi(F.col("hit_rate"), F.col("false_alarm_rate")).alias("sedi")))


_SUITE = "\nUNION ALL ".join(
    f"""SELECT part, '{name}' AS classifier, count_if(o AND value > {limit})::BIGINT AS tp, count_if(NOT o AND value > {limit})::BIGINT AS fp,
        count_if(o AND NOT value > {limit})::BIGINT AS fn, count_if(NOT o AND NOT value > {limit})::BIGINT AS tn FROM s GROUP BY 1"""
    for name, limit in (("low", 50), ("high", 200))
)


@query(
    "mt_suite",
    f"""WITH s AS (SELECT CASE WHEN day(ts) <= 20 THEN 'train' ELSE 'test' END AS part, event_type IN ('purchase', 'signup') AS o, value FROM events),
            c AS ({_SUITE}), r AS (SELECT *, tp / (tp + fn) AS h, fp / (fp + tn) AS f FROM c)
       SELECT part, classifier, tp, fp, fn, tn, round(tp / (tp + fp), 9) AS precision_1, round(h, 9) AS recall_1, round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1_1,
              round(tn / (tn + fn), 9) AS precision_0, round(tn / (tn + fp), 9) AS recall_0, round(2.0 * tn / (2 * tn + fp + fn), 9) AS f1_0,
              round(h, 9) AS hit_rate, round(f, 9) AS false_alarm_rate,
              round(CASE WHEN h > 0 AND h < 1 AND f > 0 AND f < 1 THEN
                (ln(f) - ln(h) - ln(1 - f) + ln(1 - h)) / (ln(f) + ln(h) + ln(1 - f) + ln(1 - h)) END, 9) AS sedi FROM r""",
)
def mt_suite(t: Tables):
    """Two classifiers on the days of training and of testing."""
    rows = t.events.withColumn("part", F.when(F.day("ts") <= 20, "train").otherwise("test"))
    forecasts = {"low": F.col("value") > 50, "high": F.col("value") > 200}
    return rounded(ops.score_table(rows, F.col("event_type").isin("purchase", "signup"), forecasts, ["part"]), 9)


@query(
    "mt_threshold_sweep",
    """WITH s AS (SELECT event_type IN ('purchase', 'signup') AS o, value / 500 AS score FROM events),
            k AS (SELECT 0.001::DOUBLE + i * 0.005::DOUBLE AS threshold FROM range(199) AS r(i)),
            c AS (SELECT threshold, count_if(o AND score > threshold) / count_if(o) AS h, count_if(NOT o AND score > threshold) / count_if(NOT o) AS f
                  FROM s, k GROUP BY 1)
       SELECT round(threshold, 9) AS threshold, round(h, 9) AS hit_rate, round(f, 9) AS false_alarm_rate,
              round(CASE WHEN h > 0 AND h < 1 AND f > 0 AND f < 1 THEN
                (ln(f) - ln(h) - ln(1 - f) + ln(1 - h)) / (ln(f) + ln(h) + ln(1 - f) + ln(1 - h)) END, 9) AS sedi FROM c""",
)
def mt_threshold_sweep(t: Tables):
    got = ops.threshold_sweep(t.events, F.col("event_type").isin("purchase", "signup"), F.col("value") / 500)
    return rounded(got, 9)


_BASES = f"""WITH {FIELDS_SQL}, b AS (SELECT y, x, coalesce(min(CASE WHEN cloud > 0.25 THEN level - 1 END), 69) AS o,
  coalesce(min(CASE WHEN w > 1.5 THEN level - 1 END), 69) AS f FROM fields GROUP BY y, x)"""


def _bases(t: Tables):
    """Observed and forecast base of every column of the grid."""

    def base(cond):
        return F.coalesce(F.min(F.when(cond, F.col("level") - 1)), F.lit(69))

    return model_fields(t).groupBy("y", "x").agg(base(F.col("cloud") > 0.25).alias("o"), base(F.col("w") > 1.5).alias("f"))


_LEVELS = f"""{_BASES}, raw AS (
    SELECT CAST(level AS INTEGER) AS level, count_if(o <= level AND f <= level)::BIGINT AS a, count_if(o > level AND f <= level)::BIGINT AS b,
           count_if(o <= level AND f > level)::BIGINT AS c, count_if(o > level AND f > level)::BIGINT AS d
    FROM b, range(53) AS r(level) GROUP BY 1),
  adj AS (SELECT level, CASE WHEN a = 0 OR b = 0 THEN a + 1 ELSE a END AS a, CASE WHEN a = 0 OR b = 0 THEN b + 1 ELSE b END AS b, c, d FROM raw)"""


@query("mt_level_contingency", f"{_LEVELS} SELECT level, a, b, c, d FROM adj")
def mt_level_contingency(t: Tables):
    return ops.level_contingency(_bases(t), "o", "f")


@query(
    "mt_seds",
    f"""{_LEVELS}, s AS (SELECT level, a / (a + c) AS h, b / (b + d) AS f, a, b, c, a + b + c + d AS n FROM adj),
          k AS (SELECT level, CASE WHEN h > 0 AND h < 1 AND f > 0 AND f < 1 THEN
                  (ln(f) - ln(h) - ln(1 - f) + ln(1 - h)) / (ln(f) + ln(h) + ln(1 - f) + ln(1 - h)) END AS sedi,
                CASE WHEN a > 0 AND a < n THEN ln(((a + b) * (a + c) / n) / a) / ln(a / n) END AS seds FROM s)
        SELECT CAST(level AS VARCHAR) AS level, round(sedi, 4) AS sedi, round(seds, 4) AS seds FROM k
        UNION ALL SELECT 'mean', round(avg(sedi), 4), round(avg(seds), 4) FROM k""",
)
def mt_seds(t: Tables):
    scores = ops.level_scores(ops.level_contingency(_bases(t), "o", "f")).select(
        F.col("level").cast("string").alias("level"), "sedi", "seds"
    )
    means = scores.agg(F.lit("mean").alias("level"), F.avg("sedi").alias("sedi"), F.avg("seds").alias("seds"))
    return rounded(scores.unionByName(means))


@query(
    "mt_errors",
    f"""{_BASES} SELECT round(avg(CASE WHEN f = o THEN 1.0 ELSE 0 END), 4) AS accuracy, round(avg(f - o), 4) AS mean_error,
        round(avg(abs(f - o)), 4) AS mean_absolute_error, round(sqrt(avg((f - o) * (f - o))), 4) AS root_mean_squared_error FROM b""",
)
def mt_errors(t: Tables):
    return rounded(ops.error_summary(_bases(t), F.col("o"), F.col("f")))


@query(
    "mt_direction",
    f"{_BASES} SELECT count_if(f > o)::BIGINT AS too_high, count_if(f < o)::BIGINT AS too_low, count_if(f = o)::BIGINT AS correct FROM b",
)
def mt_direction(t: Tables):
    return ops.direction(_bases(t), F.col("o"), F.col("f"))


@query(
    "mt_r2_mse",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem),
            p AS (SELECT l_linenumber, l_extendedprice AS o, (SELECT i FROM f) + (SELECT s FROM f) * l_quantity AS p FROM lineitem)
       SELECT l_linenumber, round(1 - sum((o - p) * (o - p)) / (var_pop(o) * count(o)), 4) AS r2, round(avg((o - p) * (o - p)), 0) AS mse
       FROM p GROUP BY 1""",
)
def mt_r2_mse(t: Tables):
    """How well one line fits the price of each line number."""
    fit = t.lineitem.agg(
        F.regr_slope("l_extendedprice", "l_quantity").alias("s"), F.regr_intercept("l_extendedprice", "l_quantity").alias("i")
    )
    s, i = fit.select("s").scalar(), fit.select("i").scalar()
    rows = t.lineitem.withColumn("p", i + s * F.col("l_quantity"))
    got = ops.r2_mse(rows, F.col("l_extendedprice"), F.col("p"), ["l_linenumber"])
    return rounded(got.withColumn("mse", F.round("mse", 0)))


@query(
    "mt_map_diff",
    f"""WITH {FIELDS_SQL} SELECT a.level, a.y, a.x, a.cloud AS forecast, b.cloud AS observed, a.cloud - b.cloud AS error
        FROM fields a JOIN fields b ON a.y = b.y AND a.x = b.x AND a.level = b.level + 1""",
)
def mt_map_diff(t: Tables):
    """Every level forecast by the one below it."""
    fields = model_fields(t).select("level", "y", "x", "cloud")
    return ops.map_difference(fields, fields.withColumn("level", F.col("level") + 1), ["level", "y", "x"], "cloud")
