"""Column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..functions import units
from ..operators import sampling
from .catalog import Tables, query, rounded
from .derived import FIELDS_SQL, model_fields


def _cell(column):
    return F.round(column, 9)


@query(
    "fn_uv_wind",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, round(sin(radians(dir)) * speed, 7) AS u_wind, round(cos(radians(dir)) * speed, 7) AS v_wind
        FROM (SELECT *, x * 7.2 + 0.1 AS dir, q / 1000 AS speed FROM fields)""",
)
def fn_uv_wind(t: Tables):
    rows = model_fields(t).select("level", "y", "x", (F.col("x") * 7.2 + 0.1).alias("dir"), (F.col("q") / 1000).alias("speed"))
    return rows.select(
        "level",
        "y",
        "x",
        F.round(fn.wind_u(F.col("dir"), F.col("speed")), 7).alias("u_wind"),
        F.round(fn.wind_v(F.col("dir"), F.col("speed")), 7).alias("v_wind"),
    )


@query(
    "fn_uv_wind_levels",
    f"""WITH {FIELDS_SQL} SELECT y, x, {', '.join(
        f"round(sum(CASE WHEN level = {k} THEN {f}(radians(x * 7.2 + 0.1)) * (q / 1000) END), 7) AS {c}_wind_{k}"
        for k in range(1, 8) for c, f in (('u', 'sin'), ('v', 'cos')))} FROM fields GROUP BY y, x""",
)
def fn_uv_wind_levels(t: Tables):
    """All levels of a wide table with one generated select list."""
    wide = model_fields(t).groupBy("y", "x").agg(
        *[F.max(F.when(F.col("level") == k, F.col("q") / 1000)).alias(f"windspd_{k}") for k in range(1, 8)],
        *[F.first(F.col("x") * 7.2 + 0.1).alias(f"winddir_{k}") for k in range(1, 8)],
    )
    return rounded(wide.select("y", "x", *fn.wind_components([str(k) for k in range(1, 8)])), 7)


@query(
    "fn_cyclic_hour",
    "SELECT event_id, round(sin(hour(ts) / 23.0 * pi()), 9) AS hour_sin, round(cos(hour(ts) / 23.0 * pi()), 9) AS hour_cos FROM events",
)
def fn_cyclic_hour(t: Tables):
    s, c = fn.cyclic_hour(F.hour("ts"))
    return t.events.select("event_id", _cell(s).alias("hour_sin"), _cell(c).alias("hour_cos"))


@query(
    "fn_virtual_temp",
    f"""WITH {FIELDS_SQL}, v AS (SELECT *, CAST(floor(y / 32) AS INTEGER) AS ty, CAST(floor(x / 32) AS INTEGER) AS tx,
          (temperature + 0.6 * humidity) * theta / temperature AS tv FROM fields)
        SELECT level, y, x, round(tv, 9) AS thetav, round(tv - avg(tv) OVER (PARTITION BY level, ty, tx), 6) AS deviation FROM v""",
)
def fn_virtual_temp(t: Tables):
    """The deviation is from the mean of a tile of fixed size."""
    from pyspark.sql import Window

    tile = Window.partitionBy("level", F.floor(F.col("y") / 32), F.floor(F.col("x") / 32))
    rows = model_fields(t).withColumn(
        "thetav", fn.virtual_potential_temperature(F.col("temperature"), F.col("humidity"), F.col("theta"))
    )
    return rows.select(
        "level", "y", "x", _cell(F.col("thetav")).alias("thetav"), F.round(F.col("thetav") - F.avg("thetav").over(tile), 6).alias("deviation")
    )


@query(
    "fn_total_water",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, round(humidity + cloud + w / 1000 + humidity + cloud, 9) AS total_water,
          round((temperature - 2.501e6 / 1005.0 * (humidity + w / 1000) - 2.834e6 / 1005.0 * (cloud / 1000 + humidity)) * (theta / temperature), 9) AS theta_li
        FROM fields""",
)
def fn_total_water(t: Tables):
    c = F.col
    return model_fields(t).select(
        "level",
        "y",
        "x",
        _cell(fn.total_water(c("humidity"), c("cloud"), c("w") / 1000, c("humidity"), c("cloud"))).alias("total_water"),
        _cell(
            fn.liquid_ice_theta(c("temperature"), c("theta"), c("humidity"), c("w") / 1000, c("cloud") / 1000, c("humidity"))
        ).alias("theta_li"),
    )


@query(
    "fn_unit_convert",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, round(temperature - 273.15, 9) AS celsius,
          round(temperature * 9 / 5 - 459.67, 9) AS fahrenheit, round(q / 100, 9) AS hpa FROM fields""",
)
def fn_unit_convert(t: Tables):
    rows = model_fields(t).select("level", "y", "x", F.col("temperature").alias("celsius"), F.col("temperature").alias("fahrenheit"), F.col("q").alias("hpa"))
    for column, unit, target in (("celsius", "K", "celsius"), ("fahrenheit", "K", "fahrenheit"), ("hpa", "Pa", "hPa")):
        rows = units.convert_unit(units.set_unit(rows, column, unit), column, target)
    return rounded(rows, 9)


@query(
    "fn_unit_check",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice / l_quantity AS ratio, 'm/(s)' AS unit FROM lineitem",
)
def fn_unit_check(t: Tables):
    rows = units.set_unit(units.set_unit(t.lineitem, "l_extendedprice", "m"), "l_quantity", "s")
    out = units.combine(rows, "l_extendedprice", "l_quantity", "/", "ratio")
    unit = units.unit_of(out, "ratio")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "ratio").withColumn("unit", F.lit(unit))


@query(
    "fn_date_parts",
    """SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, hour(o_orderdate)::INTEGER AS hour,
              CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'djf' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'mam'
                   WHEN month(o_orderdate) IN (6, 7, 8) THEN 'jja' ELSE 'son' END AS season,
              CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade, isodow(o_orderdate)::INTEGER AS day_of_week, dayofyear(o_orderdate)::INTEGER AS day_of_year
       FROM orders""",
)
def fn_date_parts(t: Tables):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.hour(d).alias("hour"),
        fn.season(F.month(d)).alias("season"),
        fn.decade(F.year(d)).alias("decade"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
    )


@query(
    "fn_epoch_units",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) - DATE '1990-01-01' AS days, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS back FROM orders""",
)
def fn_epoch_units(t: Tables):
    days = fn.days_since(F.col("o_orderdate"), "1990-01-01")
    back = fn.date_of_days(days, "1990-01-01").cast("string")
    return t.orders.select("o_orderkey", days.cast("long").alias("days"), back.alias("back"))


@query(
    "fn_regex",
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, '/([a-z]{2})/(\d+)', 1) AS lang,
               CAST(regexp_extract(url, '/([a-z]{2})/(\d+)', 2) AS INTEGER) AS number FROM pages""",
)
def fn_regex(t: Tables):
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
        F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 1).alias("lang"),
        F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 2).try_cast("int").alias("number"),
    )


@query("fn_split_label", "SELECT doc_id, doc_id || '.jpg' AS image, source AS label FROM documents")
def fn_split_label(t: Tables):
    labelled = t.documents.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".jpg_"), "source").alias("image_label"))
    image, label = fn.split_label(F.col("image_label"))
    return labelled.select("doc_id", image.alias("image"), label.alias("label"))


@query("fn_substr", "SELECT doc_id, substring(text, 1, 25) AS title, count(*) OVER (PARTITION BY substring(text, 1, 25)) AS n FROM documents")
def fn_substr(t: Tables):
    titles = t.documents.select("doc_id", F.substring("text", 1, 25).alias("title"))
    counts = titles.groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    return titles.join(counts, "title").select("doc_id", "title", "n")


@query(
    "fn_minmax_fixed",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, round((temperature - 140) / 180, 9) AS temperature, round(humidity / 0.025, 9) AS humidity,
          round(q / 106000, 9) AS pressure FROM fields""",
)
def fn_minmax_fixed(t: Tables):
    return model_fields(t).select(
        "level",
        "y",
        "x",
        _cell(fn.scaled_temperature(F.col("temperature"))).alias("temperature"),
        _cell(fn.scaled_humidity(F.col("humidity"))).alias("humidity"),
        _cell(fn.scaled_pressure(F.col("q"))).alias("pressure"),
    )


@query(
    "fn_minmax_clipped",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, CASE WHEN level * 10 >= 51 THEN 0.0 ELSE round(least(greatest(w / 40 / 0.1, -1.0), 1.0), 9) END AS wind,
          round(least(greatest(u / 1.25 / 3.0, 0.0), 1.0), 9) AS flux, round(humidity / 1e-4, 9) AS ice, round(cloud / 1000 / 3e-4, 9) AS rain, round(cloud / 1000 / 2e-4, 9) AS snow FROM fields""",
)
def fn_minmax_clipped(t: Tables):
    """Wind that is nothing in the top levels, and clipped shares."""
    return model_fields(t).select(
        "level",
        "y",
        "x",
        F.round(fn.scaled_vertical_wind(F.col("w") / 40, F.col("level") * 10), 9).alias("wind"),
        F.round(fn.scaled_mass_flux(F.col("u") / 1.25), 9).alias("flux"),
        F.round(fn.scaled_condensate(F.col("humidity")), 9).alias("ice"),
        F.round(fn.scaled_rate(F.col("cloud") / 1000, "stratiform_rain"), 9).alias("rain"),
        F.round(fn.scaled_rate(F.col("cloud") / 1000, "stratiform_snow"), 9).alias("snow"),
    )


@query(
    "fn_euclid_label",
    """SELECT p_partkey, CAST(sqrt((p_size - 10) ** 2 + (p_retailprice - 910) ** 2) < 10 AS INTEGER) AS near_a,
              CAST(sqrt((p_size - 25) ** 2 + (p_retailprice - 950) ** 2) < 10 AS INTEGER) AS near_b,
              CAST(sqrt((p_size - 30) ** 2 + (p_retailprice - 955) ** 2) < 10 AS INTEGER) AS near_c FROM part""",
)
def fn_euclid_label(t: Tables):
    centres = [(10.0, 910.0), (25.0, 950.0), (30.0, 955.0)]
    near = fn.within_centres(F.col("p_size"), F.col("p_retailprice"), centres, 10.0)
    return t.part.select("p_partkey", *[c.alias(f"near_{n}") for n, c in zip("abc", near)])


@query(
    "fn_array_bcast",
    """SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda v: v + v)), 3) AS doubled,
              round(list_sum(list_transform(embedding::DOUBLE[], lambda v: v * v)), 3) AS squared,
              round(list_sum(list_transform(embedding::DOUBLE[], lambda v: v * 3.5)), 3) AS scaled FROM embeddings""",
)
def fn_array_bcast(t: Tables):
    e = F.col("embedding").cast("array<double>")
    return rounded(
        t.embeddings.select(
            "vec_id",
            fn.array_sum(fn.array_add(e, e)).alias("doubled"),
            fn.array_sum(fn.array_multiply(e, e)).alias("squared"),
            fn.array_sum(fn.array_scale(e, 3.5)).alias("scaled"),
        ),
        3,
    )


def _masks(t: Tables):
    """A run-length mask per supplier: one run per line item."""
    runs = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(F.min("l_partkey").alias("start"), F.min("l_quantity").cast("int").alias("length"))
    return runs.select(
        F.col("l_suppkey").alias("image"),
        F.col("l_linenumber").alias("label"),
        F.concat_ws(" ", (F.col("start") + 1).cast("string"), F.col("length").cast("string"), (F.col("start") + 2001).cast("string"), (F.col("length") + 3).cast("string")).alias("encoded"),
        F.lit(40).alias("height"),
    )


@query(
    "fn_rle_decode",
    """WITH r AS (SELECT l_suppkey AS image, l_linenumber AS label, min(l_partkey) AS start, CAST(min(l_quantity) AS INTEGER) AS len FROM lineitem GROUP BY 1, 2),
            p AS (SELECT image, label, unnest(list_concat(range(start, start + len), range(start + 2000, start + 2000 + len + 3))) AS i FROM r)
       SELECT image, label, CAST(floor(i / 40) AS BIGINT) AS x, CAST(i % 40 AS BIGINT) AS y FROM p""",
)
def fn_rle_decode(t: Tables):
    return sampling.rle_pixels(_masks(t), "encoded", "height", ["image", "label"])


@query("fn_height_index", "SELECT vec_id, CAST(i - 1 AS INTEGER) AS height, round(embedding[i]::DOUBLE, 9) AS value FROM embeddings, range(1, 65) AS r(i)")
def fn_height_index(t: Tables):
    return rounded(t.embeddings.select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("height", "value")), 9)
