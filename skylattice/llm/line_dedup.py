"""Cross-site boilerplate: lines that stand on many distinct sites.

Each line hash gets a HyperLogLog sketch of the sites it was seen on; sketches
merge by aggregation, so a line of any number of documents is summed up before
the shuffle. Only lines whose estimate is near the threshold have their
distinct sites counted exactly. A boilerplate line stays at its first place
(lowest key, then place in the text) and is removed everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, spare, words

BLANKS = " \t\x0b\x0c\r"
#: Estimates within this share of the threshold are counted exactly. At 2^12
#: registers it is over thirty standard errors of the sketch.
NEAR = 0.5
LG_REGISTERS = 12


def line_of(line: Column) -> Column:
    """What makes two lines the same: all but the blanks around them."""
    return F.trim(line, F.lit(BLANKS))


def spread_lines(lines: DataFrame, sites: int) -> DataFrame:
    """Of lines (h, g, site, place) those on at least ``sites`` distinct
    sites: h, g and the first place. A null site is no site."""
    sketch = F.hll_sketch_agg("site", LG_REGISTERS)
    seen = lines.groupBy("h", "g").agg(
        sketch.alias("sketch"), F.count("site").alias("n"), F.min("place").alias("first")
    )
    # a line seen fewer times than that cannot be on so many sites
    rated = cut(seen.where(F.col("n") >= sites).select("h", "g", "first", F.hll_sketch_estimate("sketch").alias("estimate")))
    clear = rated.where(F.col("estimate") > sites * (1 + NEAR)).select("h", "g", "first")
    near = rated.where(F.col("estimate").between(sites * (1 - NEAR), sites * (1 + NEAR))).select("h", "g", "first")
    # equal (line, site) rows are reduced before the shuffle
    pairs = lines.where(F.col("site").isNotNull()).join(near.select("h", "g"), ["h", "g"], "left_semi").groupBy("h", "g", "site").count()
    exact = pairs.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= sites).select("h", "g")
    return clear.unionByName(near.join(exact, ["h", "g"]))


def remove_boilerplate(
    df: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", sites: int = 5, min_words: int = 1, removed: str = "n_removed"
) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text`` and their number in ``removed``.

    Lines of fewer than ``min_words`` words are never removed; by default every
    line that has a word is judged. A null text
    stays null with 0 lines removed; a text that loses all lines becomes
    empty. Rows equal in key, site and text are treated alike, and a null key
    or site is a value like any other, except that a null site does not count
    as a site. A column named ``removed`` is replaced, all others stay.
    """
    row, gone, its_key, its_row = (spare(df, n) for n in ("row", "gone", "its_key", "its_row"))
    marked = df.withColumn(row, F.xxhash64(F.col(site), F.col(text)))
    parts = F.split(F.col(text), "\n")
    lines = marked.select(
        F.col(key).alias("key"), F.col(row).alias("row"), F.col(site).cast("string").alias("site"), F.posexplode_outer(parts).alias("at", "line")
    ).where(F.size(words(F.col("line"))) >= min_words)
    same = line_of(F.col("line"))
    lines = cut(
        lines.select(
            F.struct("key", "row", "at").alias("place"), "site", F.xxhash64(same).alias("h"), F.hash(same).alias("g")
        )
    )
    spread = spread_lines(lines, sites)
    # struct order treats nulls as values: neither before nor after means equal
    again = (F.col("place") < F.col("first")) | (F.col("place") > F.col("first"))
    extra = lines.join(spread, ["h", "g"]).where(again)
    per_row = extra.groupBy(F.col("place.key").alias(its_key), F.col("place.row").alias(its_row)).agg(F.collect_set("place.at").alias(gone))
    joined = marked.join(per_row, F.col(key).eqNullSafe(F.col(its_key)) & (F.col(row) == F.col(its_row)), "left")
    all_places = F.sequence(F.lit(0), F.size(parts) - 1)
    rest = F.transform(F.array_except(all_places, F.col(gone)), lambda i: F.get(parts, i))
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.concat_ws("\n", rest))
    count = F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long")
    out = joined.withColumns({removed: count, text: cleaned})
    return out.drop(row, gone, its_key, its_row)
