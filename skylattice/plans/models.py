"""Models on tables, neighbours and graphs."""

from __future__ import annotations

import numpy as np
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.scalar import correlation
from ..operators import models as ops
from ..operators import neighbours, pooling, sampling, splines
from .catalog import Tables, query, rounded
from .derived import BUOYS_SQL, buoys, number_sql

COLUMNS = ["l_quantity", "l_discount", "l_tax"]


def _lines(t: Tables):
    """Line items with an id made of their own columns."""
    return t.lineitem.withColumn("id", F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))


def _line_vectors(t: Tables):
    return ops.with_vector(_lines(t), COLUMNS).select("id", "features", "l_extendedprice", "l_returnflag", *COLUMNS)


def _classes(t: Tables):
    """Embeddings with a feature vector, a binary and a ten-class label."""
    rows = ops.with_vector(t.embeddings, "embedding")
    return rows.select("vec_id", "features", F.col("label").cast("double").alias("label"), (F.col("label") <= 1).cast("double").alias("event"))


@query(
    "ml_linreg",
    """SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 2) AS estimate FROM lineitem
       UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 2) FROM lineitem""",
)
def ml_linreg(t: Tables):
    model = ops.linear_regression(t.lineitem, ["l_quantity"], "l_extendedprice")
    return rounded(ops.coefficients(t.spark, model, ["l_quantity"]), 2)


_FIT = """s AS (SELECT count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, avg(l_quantity) AS mx,
    regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy FROM lineitem),
  f AS (SELECT *, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS rs, n - 2 AS dof, 1.959963984540054 AS z FROM s),
  q AS (SELECT *, z + (z ** 3 + z) / 4 / dof + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96 / dof ** 2 AS t FROM f)"""


@query(
    "ml_linreg_ci",
    f"""WITH {_FIT}, c AS (SELECT 'slope' AS term, b AS estimate, rs / sqrt(sxx) AS se, t FROM q
          UNION ALL SELECT 'intercept', a, rs * sqrt(1 / n + mx * mx / sxx), t FROM q)
        SELECT term, round(estimate, 2) AS estimate, round(se, 2) AS se, round(estimate - t * se, 2) AS lower, round(estimate + t * se, 2) AS upper FROM c""",
)
def ml_linreg_ci(t: Tables):
    table, _ = ops.linear_intervals(t.lineitem, "l_quantity", "l_extendedprice")
    return rounded(table, 2)


@query(
    "ml_linreg_bands",
    f"""WITH {_FIT}, p AS (SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice AS y, a + b * l_quantity AS fit, rs, t,
          1 / n + (l_quantity - mx) ** 2 / sxx AS lever FROM lineitem, q)
        SELECT l_orderkey, l_partkey, l_linenumber, round(fit, 1) AS fit, round(y - fit, 1) AS residual, round(fit - t * rs * sqrt(lever), 1) AS conf_lower,
               round(fit + t * rs * sqrt(1 + lever), 1) AS pred_upper FROM p""",
)
def ml_linreg_bands(t: Tables):
    _, rows = ops.linear_intervals(t.lineitem, "l_quantity", "l_extendedprice")
    return rounded(rows.select("l_orderkey", "l_partkey", "l_linenumber", "fit", "residual", "conf_lower", "pred_upper"), 1)


_SUMS = """count(*) AS n, avg(l_extendedprice) AS my, avg(x) AS mx, avg(z) AS mz, count(*) * var_pop(x) AS xx, count(*) * var_pop(z) AS zz,
    count(*) * covar_pop(x, z) AS xz, count(*) * covar_pop(x, l_extendedprice) AS xy, count(*) * covar_pop(z, l_extendedprice) AS zy,
    count(*) * var_pop(l_extendedprice) AS yy"""
_TWO = f"""r AS (SELECT *, l_quantity AS x, l_quantity * l_quantity AS z FROM lineitem), s AS (SELECT {_SUMS} FROM r),
  b AS (SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM s),
  f AS (SELECT *, my - b1 * mx - b2 * mz AS b0, (yy - b1 * xy - b2 * zy) / (n - 3) AS s2, n - 3 AS dof, 1.959963984540054 AS z95 FROM b),
  q AS (SELECT *, z95 + (z95 ** 3 + z95) / 4 / dof + (5 * z95 ** 5 + 16 * z95 ** 3 + 3 * z95) / 96 / dof ** 2 AS t FROM f)"""


def _squared():
    return {"quantity": F.col("l_quantity"), "squared": F.col("l_quantity") * F.col("l_quantity")}


@query(
    "ml_linreg_terms",
    f"""WITH {_TWO}, c AS (SELECT 'intercept' AS term, b0 AS estimate, sqrt(s2 * (1 / n + (mx * mx * zz + mz * mz * xx - 2 * mx * mz * xz) / det)) AS se, t FROM q
          UNION ALL SELECT 'quantity', b1, sqrt(s2 * zz / det), t FROM q UNION ALL SELECT 'squared', b2, sqrt(s2 * xx / det), t FROM q)
        SELECT term, round(estimate, 4) AS estimate, round(se, 4) AS se, round(estimate - t * se, 4) AS lower, round(estimate + t * se, 4) AS upper FROM c""",
)
def ml_linreg_terms(t: Tables):
    """A squared term, with intervals."""
    table, _ = ops.linear_terms(t.lineitem, _squared(), "l_extendedprice")
    return rounded(table, 4)


@query(
    "ml_linreg_residuals",
    f"""WITH {_TWO}, p AS (SELECT r.*, b0 + b1 * r.x + b2 * r.z AS fit, s2, t,
          1 / n + ((r.x - mx) ** 2 * zz + (r.z - mz) ** 2 * xx - 2 * (r.x - mx) * (r.z - mz) * xz) / det AS lever FROM r, q)
        SELECT l_orderkey, l_partkey, l_linenumber, round(fit, 1) AS fit, round(lever, 12) AS leverage, round((l_extendedprice - fit) / sqrt(s2 * (1 - lever)), 6) AS standardised,
          round(fit - t * sqrt(s2 * lever), 1) AS conf_lower, round(fit + t * sqrt(s2 * (1 + lever)), 1) AS pred_upper FROM p""",
)
def ml_linreg_residuals(t: Tables):
    _, rows = ops.linear_terms(t.lineitem, _squared(), "l_extendedprice")
    fine = {"leverage": 12, "standardised": 6}
    columns = [F.round(c, fine.get(c, 1)).alias(c) for c in ("fit", "leverage", "standardised", "conf_lower", "pred_upper")]
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", *columns)


@query("ml_gam")
def ml_gam(t: Tables):
    """Smooth terms with penalties from the data, one of them cyclic, and a product."""
    rows = t.lineitem.withColumn("day", F.dayofyear("l_shipdate"))
    smooths = [splines.Smooth("l_quantity"), splines.Smooth("l_discount", 6), splines.Smooth("day", 8, cyclic=True, low=1.0, high=366.0)]
    model = splines.additive(rows, smooths, "l_extendedprice", {"quantity_tax": F.col("l_quantity") * F.col("l_tax")})
    scored = rows.withColumn("prediction", model.predicted())
    return rounded(scored.groupBy("l_linenumber").agg(F.avg("prediction").alias("mean_prediction"), F.avg("l_extendedprice").alias("mean_price")), 2)


def _held_out(rows, *ids: str):
    """Rows to learn from, and the others (three in ten), by a number of their id."""
    parted = sampling.split_random(rows, list(ids), 0.7, 23)
    return parted.where("part = 'train'").drop("part"), parted.where("part = 'test'").drop("part")


def _table(scored, label: str):
    return scored.groupBy(F.col(label).cast("int").alias("observed"), F.col("prediction").cast("int").alias("forecast")).agg(F.count(F.lit(1)).alias("n"))


def _classified(t: Tables, kind: str, label: str, **params):
    """Contingency table of rows that the model has not seen."""
    seen, held = _held_out(_classes(t), "vec_id")
    return _table(ops.classifier(kind, label, **params).fit(seen).transform(held), label)


@query("ml_logreg")
def ml_logreg(t: Tables):
    return _classified(t, "logistic", "label", maxIter=20, regParam=0.01)


@query("ml_svc")
def ml_svc(t: Tables):
    return _classified(t, "svc", "label", maxIter=10)


@query("ml_tree")
def ml_tree(t: Tables):
    return _classified(t, "tree", "label", maxDepth=5)


@query("ml_forest")
def ml_forest(t: Tables):
    """With balanced class weights."""
    seen, held = _held_out(_classes(t), "vec_id")
    weighted = sampling.class_weights(seen, "event", "weight", balanced=True)
    return _table(ops.classifier("forest", "event", "weight", numTrees=10, maxDepth=5).fit(weighted).transform(held), "event")


@query("ml_tree_regress")
def ml_tree_regress(t: Tables):
    rows = _line_vectors(t)
    out = rows.select("id", "l_extendedprice", "features")
    for kind, params in (("tree", {"maxDepth": 4}), ("forest", {"numTrees": 5, "maxDepth": 4})):
        keep = out.columns
        out = ops.regressor(kind, "l_extendedprice", **params).fit(rows).transform(out).select(*keep, F.col("prediction").alias(kind))
    return rounded(out.agg(correlation("l_extendedprice", "tree").alias("r_tree"), correlation("l_extendedprice", "forest").alias("r_forest")))


@query("ml_gbt")
def ml_gbt(t: Tables):
    seen, held = _held_out(_line_vectors(t), "id")
    scored = ops.regressor("gbt", "l_extendedprice", maxIter=5, maxDepth=3).fit(seen).transform(held)
    return rounded(scored.groupBy("l_returnflag").agg(F.avg("prediction").alias("mean_prediction"), F.count(F.lit(1)).alias("n")), 2)


@query("ml_mlp")
def ml_mlp(t: Tables):
    """As wide as the vectors and the labels are."""
    sizes = t.embeddings.agg(F.max(F.size("embedding")).alias("width"), F.max("label").alias("last")).first()
    return _classified(t, "mlp", "label", layers=[sizes["width"], 16, sizes["last"] + 1], maxIter=30)


def _labelled(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), "label")


@query(
    "ml_knn_predict",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
            d AS (SELECT a.vec_id AS id, b.vec_id AS nb, b.label AS label, list_distance(a.v, b.v) AS dist FROM e a, e b WHERE a.vec_id <> b.vec_id),
            k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nb) AS r FROM d),
            w AS (SELECT id, label, dist, max(CAST(dist = 0 AS INTEGER)) OVER (PARTITION BY id) AS same FROM k WHERE r <= 5),
            v AS (SELECT id, label, round(sum(CASE WHEN same = 1 THEN CAST(dist = 0 AS DOUBLE) ELSE 1 / dist END), 9) AS vote FROM w GROUP BY 1, 2),
            x AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY vote DESC, label) AS r FROM v)
       SELECT id, label AS prediction FROM x WHERE r = 1""",
)
def ml_knn_predict(t: Tables):
    rows = _labelled(t)
    return neighbours.predict_by_neighbours(rows, rows, "label", 5, exclude_self=True)


@query("ml_stack")
def ml_stack(t: Tables):
    rows = _line_vectors(t)
    members = {
        "linear": lambda: ops.regressor("linear", "l_extendedprice"),
        "tree": lambda: ops.regressor("tree", "l_extendedprice", maxDepth=4),
    }
    _, meta, held_out = ops.stacked(rows, members, "l_extendedprice", ["id"], 3, 21)
    scored = meta.transform(held_out)
    return rounded(scored.groupBy("__fold").agg(correlation("prediction", "l_extendedprice").alias("r")).withColumnRenamed("__fold", "fold"))


@query("ml_bag")
def ml_bag(t: Tables):
    rows = _line_vectors(t)
    members = ops.bagged(rows, lambda w: ops.regressor("tree", "l_extendedprice", w, maxDepth=4), ["id"], 4, 31)
    scored = ops.average_prediction(rows, members)
    return rounded(scored.groupBy("l_returnflag").agg(F.avg("prediction").alias("mean_prediction"), F.count(F.lit(1)).alias("n")), 2)


@query("ml_kmeans")
def ml_kmeans(t: Tables):
    rows = _classes(t)
    model = ops.k_means(rows, 4, 3)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    scored = model.transform(rows).withColumn("f", vector_to_array("features"))
    return rounded(scored.select("vec_id", "cluster", *neighbours.distance_columns(F.col("f"), centres)))


@query("ml_gmm")
def ml_gmm(t: Tables):
    places = ops.with_vector(buoys(t), ["longitude", "latitude"])
    return ops.gaussian_mixture(places, 3, 3).transform(places).groupBy("component").agg(F.count(F.lit(1)).alias("n"))


@query("ml_pca")
def ml_pca(t: Tables):
    """Spread of whitened components: 1 each."""
    _, project = ops.principal_components(_classes(t), 3, whiten=True)
    scored = project(_classes(t))
    return rounded(scored.agg(*[F.stddev_samp(F.col("components")[i]).alias(f"std_{i}") for i in range(3)]))


@query("ml_explained_variance")
def ml_explained_variance(t: Tables):
    model, _ = ops.principal_components(_classes(t), 10)
    return rounded(ops.explained_variance(t.spark, model))


_THREE = """s AS (SELECT avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3,
    var_pop(l_quantity) AS a, covar_pop(l_quantity, l_discount) AS b, covar_pop(l_quantity, l_tax) AS c, var_pop(l_discount) AS d, covar_pop(l_discount, l_tax) AS e,
    var_pop(l_tax) AS f, covar_pop(l_quantity, l_extendedprice) AS p, covar_pop(l_discount, l_extendedprice) AS q, covar_pop(l_tax, l_extendedprice) AS r FROM lineitem),
  t AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM s),
  k AS (SELECT my, m1, m2, m3, ((d * f - e * e) * p + (c * e - b * f) * q + (b * e - c * d) * r) / det AS b1,
    ((c * e - b * f) * p + (a * f - c * c) * q + (b * c - a * e) * r) / det AS b2, ((b * e - c * d) * p + (b * c - a * e) * q + (a * d - b * b) * r) / det AS b3 FROM t)"""


@query(
    "ml_chain",
    f"""WITH {_THREE} SELECT l_linenumber, round(avg(my + b1 * (l_quantity - m1) + b2 * (l_discount - m2) + b3 * (l_tax - m3)), 2) AS mean_prediction, count(*) AS n
        FROM lineitem, k GROUP BY 1""",
)
def ml_chain(t: Tables):
    chain = ops.scaled_model(COLUMNS, ops.regressor("linear", "l_extendedprice"))
    scored = chain.fit(_lines(t)).transform(_lines(t))
    return rounded(scored.groupBy("l_linenumber").agg(F.avg("prediction").alias("mean_prediction"), F.count(F.lit(1)).alias("n")), 2)


def _searched(t: Tables, points):
    estimator = ops.classifier("tree", "label")
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    return rounded(ops.search(_classes(t), estimator, points, evaluator, ["vec_id"], 3, 41))


@query("ml_grid")
def ml_grid(t: Tables):
    return _searched(t, ops.grid_points({"maxDepth": [2, 5], "minInstancesPerNode": [1, 5]}))


@query("ml_random")
def ml_random(t: Tables):
    return _searched(t, ops.random_points({"maxDepth": [2, 3, 4, 5], "minInstancesPerNode": [1, 3, 5]}, 3, 17))


@query("ml_cross_validate")
def ml_cross_validate(t: Tables):
    sets = {"quantity": ["l_quantity"], "all": COLUMNS}
    models = {"linear": lambda: ops.regressor("linear", "l_extendedprice"), "tree": lambda: ops.regressor("tree", "l_extendedprice", maxDepth=3)}
    rows = _lines(t).select("id", "l_extendedprice", *COLUMNS)
    return rounded(ops.cross_validate(rows, sets, models, "l_extendedprice", ["id"], 5, 51))


_LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "ml_cross_validate_linear",
    f"""WITH r AS (SELECT *, l_quantity AS x, l_discount AS z, {number_sql(*_LINE_KEY, seed=51)} % 5 AS fold FROM lineitem),
          f AS (SELECT unnest(range(0, 5)) AS held), s AS (SELECT held, {_SUMS} FROM r JOIN f ON fold <> held GROUP BY held),
          b AS (SELECT *, xy / xx AS b, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM s),
          p AS (SELECT held, l_extendedprice AS y, my + b * (x - mx) AS one, my + b1 * (x - mx) + b2 * (z - mz) AS two FROM r JOIN b ON fold = held)
        SELECT 'quantity' AS features, 'linear' AS model, held::INT AS fold, round(1 - sum((y - one) ** 2) / (count(*) * var_pop(y)), 6) AS r2 FROM p GROUP BY held
        UNION ALL SELECT 'both', 'linear', held::INT, round(1 - sum((y - two) ** 2) / (count(*) * var_pop(y)), 6) FROM p GROUP BY held""",
)
def ml_cross_validate_linear(t: Tables):
    """All folds and feature sets from one pass of sums."""
    sets = {"quantity": ["l_quantity"], "both": ["l_quantity", "l_discount"]}
    models = {"linear": lambda: ops.regressor("linear", "l_extendedprice")}
    return rounded(ops.cross_validate(t.lineitem, sets, models, "l_extendedprice", _LINE_KEY, 5, 51), 6)


_KEYS = ", ".join(_LINE_KEY)


@query(
    "ml_perm_importance",
    f"""WITH {_THREE}, o AS (SELECT l_extendedprice AS y, l_quantity AS x1, l_discount AS x2, l_tax AS x3, row_number() OVER (ORDER BY {_KEYS}) AS i FROM lineitem),
          h AS (SELECT l_quantity AS z1, l_discount AS z2, l_tax AS z3, row_number() OVER (ORDER BY {number_sql(*_LINE_KEY, seed=61)}, {_KEYS}) AS i FROM lineitem),
          w AS (SELECT o.*, h.* EXCLUDE (i), k.*, my + b1 * (x1 - m1) + b2 * (x2 - m2) + b3 * (x3 - m3) AS fit FROM o JOIN h ON o.i = h.i, k),
          g AS (SELECT sum((y - fit) ** 2) AS base, sum((y - fit - b1 * (z1 - x1)) ** 2) AS s1, sum((y - fit - b2 * (z2 - x2)) ** 2) AS s2,
                  sum((y - fit - b3 * (z3 - x3)) ** 2) AS s3, count(*) * var_pop(y) AS about FROM w)
        SELECT 'l_quantity' AS feature, round((s1 - base) / about, 4) AS importance FROM g UNION ALL SELECT 'l_discount', round((s2 - base) / about, 4) FROM g
        UNION ALL SELECT 'l_tax', round((s3 - base) / about, 4) FROM g""",
)
def ml_perm_importance(t: Tables):
    model = ops.linear_regression(t.lineitem, COLUMNS, "l_extendedprice")
    return rounded(ops.permutation_importance(t.lineitem, model, COLUMNS, "l_extendedprice", _LINE_KEY, 61))


@query("ml_feature_importance")
def ml_feature_importance(t: Tables):
    model = ops.regressor("forest", "l_extendedprice", numTrees=5, maxDepth=4).fit(_line_vectors(t))
    return rounded(ops.tree_importances(t.spark, model, COLUMNS))


@query("ml_anomaly")
def ml_anomaly(t: Tables):
    scored = ops.reconstruction_errors(t.embeddings.select("vec_id", "embedding"), "embedding", 8)
    flagged = ops.anomalies(scored, "error")
    return rounded(flagged.select("vec_id", "error", "threshold", "anomalous"), 6)


@query(
    "ml_partial_pool",
    """WITH g AS (SELECT user_id, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY 1 HAVING count(value) > 1 AND var_samp(value) > 0),
            t AS (SELECT avg(m) AS centre, greatest(var_samp(m) - avg(v / n), 0) AS tau FROM g)
       SELECT user_id, n, round(m, 4) AS mean, round(sqrt(v), 4) AS sigma, round((m - centre) * tau / (tau + v / n), 4) AS offset,
              round(centre + (m - centre) * tau / (tau + v / n), 4) AS pooled FROM g, t""",
)
def ml_partial_pool(t: Tables):
    return rounded(ops.partial_pool(t.events, "user_id", "value"))


@query(
    "ml_partial_pool_em",
    """WITH RECURSIVE g AS (SELECT user_id, count(value) AS n, avg(value) AS mean, var_samp(value) AS v FROM events GROUP BY 1 HAVING count(value) > 1 AND var_samp(value) > 0),
         e AS (SELECT 0 AS i, user_id, n, mean, (n - 1) * v AS squares, v AS own, avg(mean) OVER () AS centre, var_samp(mean) OVER () AS scatter FROM g
           UNION ALL SELECT i + 1, user_id, n, mean, squares, (squares + n * ((mean - c - m) ** 2 + u)) / n, c, s FROM (
             SELECT *, sum(n / own * (mean - m)) OVER () / sum(n / own) OVER () AS c, avg(m * m + u) OVER () AS s FROM (
               SELECT *, scatter * n * (mean - centre) / (own + n * scatter) AS m, scatter * own / (own + n * scatter) AS u FROM e WHERE i < 25)))
       SELECT user_id, n, round(mean, 4) AS mean, round(sqrt(own), 4) AS sigma, round(scatter * n * (mean - centre) / (own + n * scatter), 4) AS offset,
              round(centre + scatter * n * (mean - centre) / (own + n * scatter), 4) AS pooled FROM e WHERE i = 25""",
)
def ml_partial_pool_em(t: Tables):
    """Twenty-five rounds, whatever the tolerance."""
    rows, _ = pooling.pooled_means(t.events, "user_id", "value", tolerance=0.0, most=25)
    return rounded(rows)


_EDGES = f"""{BUOYS_SQL}, d AS (SELECT a.id AS src, b.id AS dst, sqrt((a.longitude - b.longitude) ** 2 + (a.latitude - b.latitude) ** 2) AS w FROM buoys a, buoys b),
  k AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w, dst) AS r FROM d),
  edges AS (SELECT src, dst, round(w, 2) AS weight FROM k WHERE r <= 3 AND src <> dst AND NOT (src = 2 * dst))"""


def _nodes(t: Tables):
    return buoys(t).select("id", F.array("longitude", "latitude").alias("features"), "load")


def _edges(t: Tables):
    """Edges from a user to the one with half its number are taken out."""
    nodes = _nodes(t)
    removed = nodes.select((F.col("id") * 2).alias("src"), F.col("id").alias("dst"))
    return neighbours.edges(nodes, 3, removed)


@query("gr_edges", f"WITH {_EDGES} SELECT src, dst, weight FROM edges")
def gr_edges(t: Tables):
    return _edges(t)


@query(
    "gr_aggregate",
    f"""WITH {_EDGES} SELECT n.id, coalesce(s.total, 0) AS sum_load FROM buoys n
        LEFT JOIN (SELECT src, sum(load) AS total FROM edges JOIN buoys ON dst = id GROUP BY 1) s ON s.src = n.id""",
)
def gr_aggregate(t: Tables):
    return neighbours.sum_messages(_edges(t), _nodes(t), ["load"])


@query(
    "score_batch",
    """WITH e AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) AS r(i)),
            c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY 1, 2), b AS (SELECT label, -sum(m * m) / 2 AS bias FROM c GROUP BY 1),
            s AS (SELECT vec_id, c.label, sum(v * m) AS dot FROM e JOIN c ON e.i = c.i GROUP BY 1, 2),
            x AS (SELECT vec_id, s.label, row_number() OVER (PARTITION BY vec_id ORDER BY dot + bias DESC, s.label) AS r FROM s JOIN b ON s.label = b.label)
       SELECT vec_id, label AS prediction FROM x WHERE r = 1""",
)
def score_batch(t: Tables):
    """Nearest class centre as a linear score."""
    long = t.embeddings.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v"))
    # one row per class and position
    means = long.groupBy("label", "i").agg(F.avg("v").alias("m")).orderBy("label", "i").toPandas()
    table = means.pivot(index="label", columns="i", values="m").sort_index()
    centres = table.to_numpy()
    bias = -np.square(centres).sum(axis=1) / 2
    return ops.score_batches(t.embeddings, "embedding", centres.T, bias, ["vec_id"], table.index)
