"""Tiles, stencils and slices of the derived grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as ops
from .catalog import Tables, query, rounded
from .derived import FIELDS_SQL, model_fields

HEIGHTS = ops.theta_level_heights(7)
_H = "[" + ", ".join(repr(h) for h in HEIGHTS) + "]"


@query(
    "agg_block_moments",
    f"""WITH {FIELDS_SQL} SELECT level, CAST(floor(y / 32) AS INTEGER) AS tile_y, CAST(floor(x / 32) AS INTEGER) AS tile_x,
          round(avg(q), 4) AS mean, round(stddev_pop(q), 4) AS std,
          round(CASE WHEN stddev_pop(q) > 0 THEN (avg(q * q * q) - 3 * avg(q) * var_pop(q) - avg(q) ** 3) / stddev_pop(q) ** 3 ELSE 0 END, 3) AS skew
        FROM fields GROUP BY 1, 2, 3""",
)
def agg_block_moments(t: Tables):
    got = ops.block_moments(model_fields(t), ["level"], "y", "x", 32, "q")
    return rounded(got.withColumn("skew", F.round("skew", 3)))


@query(
    "agg_block_corr",
    f"""WITH {FIELDS_SQL} SELECT level, CAST(floor(y / 32) AS INTEGER) AS tile_y, CAST(floor(x / 32) AS INTEGER) AS tile_x,
          round(CASE WHEN stddev_pop(q) = 0 OR stddev_pop(w) = 0 THEN 0 ELSE corr(q, w) END, 4) AS r FROM fields GROUP BY 1, 2, 3""",
)
def agg_block_corr(t: Tables):
    return rounded(ops.block_correlation(model_fields(t), ["level"], "y", "x", 32, "q", "w"))


@query(
    "agg_masked_mean",
    f"""WITH {FIELDS_SQL},
          v AS (SELECT *, CAST(floor(y / 16) AS INTEGER) AS tile_y, CAST(floor(x / 16) AS INTEGER) AS tile_x,
                       (temperature + 0.6 * humidity) * theta / temperature AS tv, q / 1000 AS rain FROM fields),
          m AS (SELECT *, tv - avg(tv) OVER (PARTITION BY tile_y, tile_x, level) AS dtv FROM v),
          c AS (SELECT tile_y, tile_x, y, x, max(CASE WHEN dtv > 0.01 AND cloud > 0.1 AND w > 0.05 THEN 1 ELSE 0 END) AS e, max(rain) AS rain
                FROM m GROUP BY 1, 2, 3, 4)
        SELECT tile_y, tile_x, round(avg(e * rain), 8) AS rain FROM c GROUP BY 1, 2""",
)
def agg_masked_mean(t: Tables):
    fields = model_fields(t).withColumn("rain", F.col("q") / 1000)
    return rounded(ops.buoyant_rain(fields, [], "level", "y", "x", 16, 0.01, 0.1, 0.05), 8)


@query(
    "grid_slices",
    f"WITH {FIELDS_SQL} SELECT level, x, count(*) AS n_cells, min(q) AS lo, max(q) AS hi, round(avg(w), 9) AS mean_w FROM fields GROUP BY 1, 2",
)
def grid_slices(t: Tables):
    aggs = [F.count(F.lit(1)).alias("n_cells"), F.min("q").alias("lo"), F.max("q").alias("hi"), F.avg("w").alias("mean_w")]
    return rounded(ops.per_slice(model_fields(t), ["level", "x"], aggs), 9, exact=("lo", "hi"))


@query(
    "grid_gradient",
    f"""WITH {FIELDS_SQL} SELECT c.level, c.y, c.x, (c.q - w.q) / 1500 AS d_dx, (c.q - s.q) / 1500 AS d_dy,
          (c.q - d.q) / ({_H}[c.level] - {_H}[c.level - 1]) AS d_dz
        FROM fields c LEFT JOIN fields w ON w.level = c.level AND w.y = c.y AND w.x = c.x - 1
          LEFT JOIN fields s ON s.level = c.level AND s.y = c.y - 1 AND s.x = c.x
          LEFT JOIN fields d ON d.level = c.level - 1 AND d.y = c.y AND d.x = c.x""",
)
def grid_gradient(t: Tables):
    return ops.gradient(model_fields(t).select("level", "y", "x", "q"), [], "level", "y", "x", "q", HEIGHTS, 1)


@query(
    "grid_advection",
    f"""WITH {FIELDS_SQL},
          f AS (SELECT c.*, up.q AS q_up, dn.q AS q_dn, up.w AS w_up, dn.w AS w_dn,
                       (c.u + coalesce(up.u, c.u)) * 0.5 AS uf, (c.v + coalesce(up.v, c.v)) * 0.5 AS vf
                FROM fields c LEFT JOIN fields up ON up.level = c.level + 1 AND up.y = c.y AND up.x = c.x
                              LEFT JOIN fields dn ON dn.level = c.level - 1 AND dn.y = c.y AND dn.x = c.x)
        SELECT c.level, c.y, c.x, coalesce(
            (c.uf * (c.q - w.q) - e.uf * (e.q - c.q)) / 1500 + (c.vf * (c.q - s.q) - n.vf * (n.q - c.q)) / 1500
            + CASE WHEN c.level > 1 AND c.level < 7 THEN coalesce((c.w + c.w_dn) * 0.5 * (c.q - c.q_dn) / ({_H}[c.level] - {_H}[c.level - 1]), 0) ELSE 0 END
            - CASE WHEN c.level < 6 THEN coalesce((c.w + c.w_up) * 0.5 * (c.q_up - c.q) / ({_H}[c.level + 1] - {_H}[c.level]), 0) ELSE 0 END, 0) AS advection
        FROM f c LEFT JOIN f w ON w.level = c.level AND w.y = c.y AND w.x = c.x - 1 LEFT JOIN f e ON e.level = c.level AND e.y = c.y AND e.x = c.x + 1
          LEFT JOIN f s ON s.level = c.level AND s.y = c.y - 1 AND s.x = c.x LEFT JOIN f n ON n.level = c.level AND n.y = c.y + 1 AND n.x = c.x""",
)
def grid_advection(t: Tables):
    fields = model_fields(t).select("level", "y", "x", "q", "u", "v", "w")
    return ops.advection(fields, [], "level", "y", "x", HEIGHTS, 1)
