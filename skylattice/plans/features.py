"""Features, samples and splits."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import aggregates, neighbours, sampling, tiles
from ..operators import features as ft
from .catalog import Tables, query, rounded, stamp
from .derived import FIELDS_SQL, STATIONS, STATIONS_SQL, hourly_stations, model_fields, number_sql, station_ids, unit_sql

_WORDS = r"""list_filter(string_split(regexp_replace(lower(text), '[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]', ' ', 'g'), ' '), lambda w: w <> '')"""
_VOCAB = f"""counts AS (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM documents) GROUP BY 1),
  vocab AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS word_id FROM counts ORDER BY n DESC, word LIMIT 49)"""


_KINDS = ("click", "error", "purchase", "signup", "view")


@query("ft_hash_bucket", f"SELECT doc_id, source, CAST({number_sql('source')} % 10 AS INTEGER) AS bucket FROM documents")
def ft_hash_bucket(t: Tables):
    return t.documents.select("doc_id", "source", ft.hash_bucket(F.col("source")).alias("bucket"))


@query(
    "ft_onehot",
    f"""SELECT event_id, {', '.join(f"CAST(event_type = '{w}' AS INTEGER) AS event_type_{w}" for w in _KINDS)},
              list_position([{', '.join(f"'{w}'" for w in _KINDS)}], event_type) - 1 AS at FROM events""",
)
def ft_onehot(t: Tables):
    words = ft.one_hot_words(t.events, "event_type", _KINDS)
    hot = ft.one_hot_inferred(words, "event_type", "hot").withColumn("a", vector_to_array("hot"))
    return hot.select("event_id", *[f"event_type_{w}" for w in _KINDS], (F.array_position("a", F.lit(1.0)) - 1).cast("int").alias("at"))


@query(
    "ft_label_encode",
    "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS brand, dense_rank() OVER (ORDER BY p_size) - 1 AS size FROM part",
)
def ft_label_encode(t: Tables):
    rows = ft.label_encode(t.part.select("p_partkey", "p_brand", "p_size"), "p_brand", "brand")
    return ft.label_encode(rows, "p_size", "size").select("p_partkey", F.col("brand").cast("long").alias("brand"), F.col("size").cast("long").alias("size"))


@query(
    "ft_category_map",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS code FROM orders",
)
def ft_category_map(t: Tables):
    return ft.map_categories(t.orders, "o_orderstatus", {"O": 1, "F": 2}, "code").select("o_orderkey", "code")


@query(
    "ft_standardise",
    """WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
       SELECT o_orderkey, round((o_totalprice - m) / d, 8) AS o_totalprice FROM orders, s""",
)
def ft_standardise(t: Tables):
    """Fitted on the orders before 1999, applied to all."""
    train = sampling.split_by_time(t.orders, "o_orderdate", "1999-01-01").where(F.col("part") == "train")
    fitted = ft.fit_moments(train, ["o_totalprice"])
    return rounded(ft.standardise(t.orders.select("o_orderkey", "o_totalprice"), fitted, ["o_totalprice"]), 8)


@query(
    "ft_minmax",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
       SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 9) AS o_totalprice FROM orders, s""",
)
def ft_minmax(t: Tables):
    train = sampling.split_by_time(t.orders, "o_orderdate", "1999-01-01").where(F.col("part") == "train")
    fitted = ft.fit_range(train, ["o_totalprice"])
    return rounded(ft.scale_range(t.orders.select("o_orderkey", "o_totalprice"), fitted, ["o_totalprice"]), 9)


@query(
    "ft_minmax_level",
    f"""WITH {FIELDS_SQL}, s AS (SELECT level, min(q) AS lo, max(q) AS hi FROM fields GROUP BY 1)
        SELECT f.level, y, x, round(CASE WHEN hi > lo THEN (q - lo) / (hi - lo) ELSE q - lo END, 9) AS q FROM fields f JOIN s ON f.level = s.level""",
)
def ft_minmax_level(t: Tables):
    rows = model_fields(t).select("level", "y", "x", "q")
    return rounded(ft.scale_range(rows, ft.fit_range(rows, ["q"], ["level"]), ["q"], ["level"]), 9)


@query(
    "ft_standardise_level",
    f"""WITH {FIELDS_SQL}, s AS (SELECT level, avg(q) AS m, stddev_pop(q) AS d, avg(w) AS mw, stddev_pop(w) AS dw FROM fields GROUP BY 1)
        SELECT f.level, y, x, round((q - m) / d, 5) AS q, round((w - mw) / dw, 5) AS w FROM fields f JOIN s ON f.level = s.level""",
)
def ft_standardise_level(t: Tables):
    rows = model_fields(t).select("level", "y", "x", "q", "w")
    return rounded(ft.standardise(rows, ft.fit_moments(rows, ["q", "w"], ["level"]), ["q", "w"], ["level"]), 5)


@query(
    "ft_standardise_sample",
    """WITH e AS (SELECT vec_id, i - 1 AS level, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) AS r(i))
       SELECT vec_id, CAST(level AS INTEGER) AS level, round((v - avg(v) OVER w) / stddev_samp(v) OVER w, 4) AS z FROM e WINDOW w AS (PARTITION BY vec_id)""",
)
def ft_standardise_sample(t: Tables):
    z = ft.standardise_profile(F.col("embedding").cast("array<double>"))
    return rounded(t.embeddings.select("vec_id", F.posexplode(z).alias("level", "z")))


@query(
    "ft_bow_pad",
    f"""WITH {_VOCAB},
          w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM (SELECT doc_id, {_WORDS} AS words FROM documents)),
          k AS (SELECT doc_id, word_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos DESC) AS back FROM w JOIN vocab USING (word)),
          s AS (SELECT doc_id, string_agg(CAST(word_id AS VARCHAR), ' ' ORDER BY back DESC) AS ids, count(*) AS n FROM k WHERE back <= 20 GROUP BY 1)
        SELECT d.doc_id, trim(coalesce(s.ids, '') || repeat(' 0', CAST(20 - coalesce(s.n, 0) AS INTEGER))) AS ids FROM documents d LEFT JOIN s USING (doc_id)""",
)
def ft_bow_pad(t: Tables):
    vocab = ft.vocabulary(t.documents, "text", 50)
    ids = ft.bag_of_ids(t.documents, "text", vocab, 20)
    return ids.select("doc_id", F.concat_ws(" ", F.transform("ids", lambda i: i.cast("string"))).alias("ids"))


@query("ft_vocabulary", f"WITH {_VOCAB} SELECT word, word_id::INTEGER AS word_id, n FROM vocab")
def ft_vocabulary(t: Tables):
    return ft.vocabulary(t.documents, "text", 50)


@query(
    "ft_assemble",
    """SELECT l_orderkey, l_partkey, l_linenumber, 3 AS size, round(l_quantity + l_discount + l_tax, 4) AS total FROM lineitem""",
)
def ft_assemble(t: Tables):
    rows = ft.assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"]).withColumn("a", vector_to_array("features"))
    total = F.aggregate("a", F.lit(0.0), lambda s, v: s + v)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.size("a").alias("size"), F.round(total, 4).alias("total"))


@query(
    "ft_mask_target",
    f"""WITH {STATIONS_SQL}, f AS (SELECT *, strftime(time, '%Y-%m-%d %H:%M:%S') AS hour FROM stations WHERE time IN
          (SELECT time FROM stations GROUP BY time HAVING count(DISTINCT station_id) = (SELECT count(DISTINCT event_type) FROM events))),
        m AS (SELECT *, station_id = list_extract([{', '.join(f"'{s}'" for s in STATIONS)}], {number_sql('hour', seed=5)} % {len(STATIONS)} + 1) AS hidden FROM f)
        SELECT hour AS time, station_id, hidden, CASE WHEN hidden THEN 0 ELSE value END AS value, CASE WHEN hidden THEN 0 ELSE reports END AS reports,
          CASE WHEN hidden THEN value END AS target_value, CASE WHEN hidden THEN reports END AS target_reports FROM m""",
)
def ft_mask_target(t: Tables):
    """Hours in which all stations report: one is hidden."""
    stations = station_ids(t)
    full = aggregates.complete_groups(hourly_stations(t), ["time"], "station_id", len(stations))
    masked = ft.mask_one_station(full, ["time"], "station_id", stations, ["value", "reports"], 5)
    return masked.select(stamp("time"), "station_id", "hidden", "value", "reports", "target_value", "target_reports")


@query(
    "ft_poly",
    """SELECT s_suppkey, round(s_acctbal * s_acctbal, 2) AS s_acctbal_squared, round(s_acctbal, 2) AS x, round(s_acctbal * s_acctbal, 2) AS xx,
              s_nationkey::DOUBLE AS y, round(s_acctbal * s_nationkey, 2) AS xy, (s_nationkey * s_nationkey)::DOUBLE AS yy FROM supplier""",
)
def ft_poly(t: Tables):
    """Squared term beside the full expansion."""
    rows = ft.add_square(t.supplier, "s_acctbal")
    poly = ft.polynomial(rows, ["s_acctbal", "s_nationkey"]).withColumn("a", vector_to_array("poly"))
    terms = [F.col("a")[i].alias(n) for i, n in enumerate(("x", "xx", "y", "xy", "yy"))]
    return rounded(poly.select("s_suppkey", "s_acctbal_squared", *terms), 2)


# --- samples and splits --------------------------------------------------


@query("sm_frac", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {unit_sql('o_orderkey', seed=3)} < 0.1::DOUBLE")
def sm_frac(t: Tables):
    return sampling.sample_fraction(t.orders, ["o_orderkey"], 0.1, 3).select("o_orderkey", "o_totalprice")


@query(
    "sm_replace",
    f"""WITH k AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders),
            d AS (SELECT r - 1 AS draw, {number_sql('r - 1', seed=3)} % n + 1 AS r FROM k)
       SELECT draw, o_orderkey, o_totalprice FROM d JOIN k ON d.r = k.r""",
)
def sm_replace(t: Tables):
    """As many draws as there are orders."""
    drawn = sampling.sample_with_replacement(t.orders, ["o_orderkey"], t.orders.count(), 3)
    return drawn.select("draw", "o_orderkey", "o_totalprice")


@query("sm_resample")
def sm_resample(t: Tables):
    """How often each event is drawn when as many are drawn as there are: the
    number of events by the number of times."""
    counts = sampling.draw_counts(t.events.select("event_id", "event_type"), ["event_id"], t.events.count(), 19)
    return counts.groupBy("drawn").agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_type").alias("n_types"))


@query(
    "sm_stratified",
    f"""WITH h AS (SELECT o_orderkey, o_orderstatus, {number_sql('o_orderkey', seed=5)} AS h FROM orders),
            k AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS r,
                    CAST(floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.1::DOUBLE) AS BIGINT) AS tenth FROM h)
       SELECT o_orderkey, o_orderstatus, CASE WHEN r <= tenth THEN 'test' WHEN r <= 2 * tenth THEN 'validation' ELSE 'train' END AS part FROM k""",
)
def sm_stratified(t: Tables):
    sets = sampling.stratified_sets(t.orders, "o_orderstatus", ["o_orderkey"], 0.1, 0.1, 5)
    return sets.select("o_orderkey", "o_orderstatus", "part")


@query(
    "sm_undersample",
    f"SELECT event_id, event_type, value FROM events WHERE event_type = 'signup' OR {unit_sql('event_id', seed=9)} < 0.05::DOUBLE",
)
def sm_undersample(t: Tables):
    return sampling.undersample(t.events, "event_type", "signup", ["event_id"], 0.05, 9).select("event_id", "event_type", "value")


def _vectors(t: Tables):
    """Embeddings as (id, features, label), label 1 for the labels 0 and 1."""
    return t.embeddings.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), (F.col("label") <= 1).cast("int").alias("rare")
    )


@query(
    "sm_smote",
    "SELECT CAST(label <= 1 AS INTEGER) AS rare, greatest(count(*), (SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label <= 1))) AS n, 64 AS width FROM embeddings GROUP BY 1",
)
def sm_smote(t: Tables):
    """Class sizes after the new rows are added."""
    rows = _vectors(t)
    new = neighbours.smote(rows, "rare", 5, 13)
    both = rows.select("rare", "features").unionByName(new.select("rare", "features"))
    return both.groupBy("rare").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width"))


@query(
    "sm_smote_rows",
    f"""WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, CAST(label <= 1 AS INTEGER) AS rare FROM embeddings),
            s AS (SELECT rare, count(*) AS size FROM e GROUP BY 1),
            w AS (SELECT rare, size, (SELECT max(size) FROM s) - size AS need FROM s),
            m AS (SELECT e.*, row_number() OVER (PARTITION BY e.rare ORDER BY id) AS row_no FROM e JOIN w ON e.rare = w.rare WHERE need > 0),
            d AS (SELECT a.id, b.id AS nb, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS r
                  FROM m a JOIN m b ON a.rare = b.rare AND a.id <> b.id),
            g AS (SELECT rare, size, unnest(range(0, need)) AS draw FROM w WHERE need > 0),
            u AS (SELECT rare, draw, floor({unit_sql('rare', 'draw', seed=13)} * size) + 1 AS row_no, floor({unit_sql('rare', 'draw', seed=14)} * least(5, size - 1)) + 1 AS r, {unit_sql('rare', 'draw', seed=15)} AS u FROM g),
            x AS (SELECT u.draw, u.rare, list_transform(range(1, 65), lambda i: a.v[i] + u.u * (b.v[i] - a.v[i])) AS f
                  FROM u JOIN m a ON u.rare = a.rare AND u.row_no = a.row_no JOIN d ON d.id = a.id AND d.r = u.r JOIN m b ON b.id = d.nb)
       SELECT draw, rare, round(f[1], 9) AS first, round(f[64], 9) AS last, round(list_sum(f), 7) AS total FROM x""",
)
def sm_smote_rows(t: Tables):
    """The new rows themselves."""
    new = neighbours.smote(_vectors(t), "rare", 5, 13)
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x)
    return new.select(
        "draw", "rare", F.round(F.get("features", F.lit(0)), 9).alias("first"), F.round(F.get("features", F.lit(63)), 9).alias("last"), F.round(total, 7).alias("total")
    )


@query(
    "sm_class_weight",
    """WITH c AS (SELECT event_type, count(*) AS k FROM events GROUP BY 1), n AS (SELECT count(*) AS n, count(DISTINCT event_type) AS m FROM events)
       SELECT event_id, round(n / k / 2, 9) AS weight, round(n / k / m, 9) AS balanced FROM events e JOIN c ON e.event_type = c.event_type, n""",
)
def sm_class_weight(t: Tables):
    rows = sampling.class_weights(t.events, "event_type")
    return rounded(sampling.class_weights(rows, "event_type", "balanced", True).select("event_id", "weight", "balanced"), 9)


@query("sp_random", f"SELECT o_orderkey, CASE WHEN {unit_sql('o_orderkey', seed=1)} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM orders")
def sp_random(t: Tables):
    return sampling.split_random(t.orders, ["o_orderkey"], 0.8, 1).select("o_orderkey", "part")


@query(
    "sp_group",
    f"SELECT conv_id, turn, CASE WHEN {unit_sql('conv_id', seed=1)} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM conversations",
)
def sp_group(t: Tables):
    """All turns of a conversation are in one part."""
    return sampling.split_by_group(t.conversations, ["conv_id"], 0.8, 1).select("conv_id", "turn", "part")


@query(
    "sp_time",
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-06-15' THEN 'train' ELSE 'test' END AS part FROM orders
       WHERE o_orderdate <> TIMESTAMP '1999-06-15'""",
)
def sp_time(t: Tables):
    return sampling.split_by_time(t.orders, "o_orderdate", "1999-06-15").select("o_orderkey", "part")


@query(
    "sp_ordered",
    """SELECT o_orderkey, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM (
         SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER () AS n FROM orders)""",
)
def sp_ordered(t: Tables):
    return sampling.split_ordered(t.orders, ["o_orderdate", "o_orderkey"], 0.8).select("o_orderkey", "part")


@query("sp_kfold", f"SELECT o_orderkey, CAST({number_sql('o_orderkey', seed=2)} % 5 AS INTEGER) AS fold FROM orders")
def sp_kfold(t: Tables):
    return sampling.with_fold(t.orders, ["o_orderkey"], 5, 2).select("o_orderkey", "fold")


@query(
    "tile_pure",
    """WITH r AS (SELECT l_suppkey AS image, l_linenumber AS label, min(l_partkey) AS start, CAST(min(l_quantity) AS INTEGER) AS len, count(*) AS n FROM lineitem GROUP BY 1, 2),
            p AS (SELECT image, label, unnest(range(start, start + 400 * len)) AS i FROM r),
            x AS (SELECT image, label, CAST(floor(i / 40) AS BIGINT) AS x, i % 40 AS y FROM p)
       SELECT image, label, CAST(floor(x / 8) AS BIGINT) AS tile_x, CAST(floor(y / 8) AS BIGINT) AS tile_y FROM x GROUP BY 1, 2, 3, 4 HAVING count(*) = 64""",
)
def tile_pure(t: Tables):
    return tiles.grid_tiles(tiles.columns_of_runs(_masks(t), "encoded", "height", "image", "label"), 8)


def _masks(t: Tables):
    """One run per supplier and line number, in images of 40 rows."""
    return (
        t.lineitem.groupBy(F.col("l_suppkey").alias("image"), F.col("l_linenumber").alias("label"))
        .agg(F.min("l_partkey").alias("start"), F.min("l_quantity").cast("int").alias("length"))
        .select(
            "image",
            "label",
            F.concat_ws(" ", (F.col("start") + 1).cast("string"), (F.col("length") * 400).cast("string")).alias("encoded"),
            F.lit(40).alias("height"),
        )
    )


@query("tile_pure_any")
def tile_pure_any(t: Tables):
    """Tiles at any place, none of which could be added."""
    return tiles.place_tiles(_masks(t), "encoded", "height", "image", "label", 8, 5)
