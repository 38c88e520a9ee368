"""Benchmark decontamination by exact comparison of item-sized windows.

1. Windows: a text window as long as an item that shares a run of word
   shingles with it, laid so that the run falls on the same words. A window
   without a common shingle has similarity 0, so nothing is lost by not
   looking at the others; a run gives one window, at its first shingle.
2. Each window meets the item of its run and no other, and is held against it
   by the exact weighted Jaccard similarity of their shingles, weighted by how
   often each occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordered import salted_join
from .common import cut, spare

SHINGLE = 5
#: Item shingles (a few dozen bytes each) that are sent to every task; more are joined by a shuffle.
BROADCAST_SHINGLES = 500_000


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def shingle_hashes(found: Column) -> Column:
    """Hash of the shingle at each word; none for fewer words than a shingle."""
    last = F.size(found) - SHINGLE
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(SHINGLE)]))


def shingles(found: Column) -> Column:
    places = F.sequence(F.lit(1), F.size(found) - (SHINGLE - 1))
    return F.transform(places, lambda i: F.concat_ws(" ", F.slice(found, i, SHINGLE)))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of the lesser over sum of the greater number of occurrences."""
    times = lambda x, s: F.size(F.filter(x, lambda y: y == s))
    each = F.transform(F.array_intersect(a, b), lambda s: F.least(times(a, s), times(b, s)))
    common = F.aggregate(each, F.lit(0), lambda n, v: n + v)
    return common / (F.size(a) + F.size(b) - common)


def contaminated(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", similarity: float = 0.8
) -> DataFrame:
    """Pairs of a row and a benchmark item found in it: the key, a hash of the
    text (``text_hash``), the item, the best ``similarity``, the first word of
    that window (``start``), its ``n_words``.

    Items of fewer words than a shingle, null texts and empty texts have no
    shingles and are in no pair. Rows equal in key and text make one pair.
    Null keys are kept. No other column of either table is used.
    """
    asked = benchmark.select(F.col(item).alias("item_id"), plain_words(F.col(item_text)).alias("item_words"))
    asked = cut(
        asked.where(F.size("item_words") >= SHINGLE)
        .distinct()
        .select(
            F.monotonically_increasing_id().alias("item"), "item_id", "item_words", F.size("item_words").alias("n_item"),
            shingles(F.col("item_words")).alias("item_shingles"),
        )
    )
    spots = asked.select("item", "n_item", shingle_hashes(F.col("item_words")).alias("hs"))
    spots = spots.select("item", "n_item", "hs", F.posexplode("hs").alias("q", "hash"))
    spots = cut(spots.select("item", "n_item", "q", "hash", F.when(F.col("q") > 0, F.get("hs", F.col("q") - 1)).alias("before")))
    few = spots.count() <= BROADCAST_SHINGLES
    # a text's words go along with each of its shingles only where these are not shuffled
    carried = ["found"] if few else []
    rows = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"), plain_words(F.col(text)).alias("found"))
    # the outer form: Spark would filter by the size of ``own`` before it is made, and make it twice
    spread = rows.select("*", shingle_hashes(F.col("found")).alias("own")).select("*", F.posexplode_outer("own").alias("p", "hash"))
    spread = spread.select(
        "key", "text_hash", *carried, F.size("found").alias("n_found"), "p", "hash", F.get("own", F.col("p") - 1).alias("previous")
    )
    hits = spread.join(F.broadcast(spots) if few else spots, "hash")
    # only where a common run begins
    fresh = ~F.coalesce(F.col("previous") == F.col("before"), F.lit(False))
    most = F.greatest(F.col("n_found") - F.col("n_item"), F.lit(0))
    start = F.greatest(F.least(F.col("p") - F.col("q"), most), F.lit(0))
    windows = hits.where(fresh).select("key", "text_hash", *carried, "item", start.alias("start"), F.col("n_item").alias("size"))
    if not few:
        texts = rows.select(F.col("key").alias("__key"), F.col("text_hash").alias("__hash"), "found")
        same = F.col("key").eqNullSafe(F.col("__key")) & (F.col("text_hash") == F.col("__hash"))
        windows = windows.distinct().join(texts, same)
    windows = windows.select("key", "text_hash", "item", "start", "size", F.slice("found", F.col("start") + 1, F.col("size")).alias("window"))
    windows = windows.dropDuplicates(["key", "text_hash", "item", "start"])
    # written with shingles, which every comparison would work out again
    windows = cut(windows.select("key", "text_hash", "item", "start", "size", shingles(F.col("window")).alias("shingles")))
    # every window is held against the item that made it, however far apart their fingerprints are
    items = asked.select("item", "item_id", "item_shingles")
    met = windows.join(F.broadcast(items), "item") if few else salted_join(windows, items, ["item"])
    rated = met.withColumn("similarity", weighted_jaccard(F.col("shingles"), F.col("item_shingles")))
    best = rated.where(F.col("similarity") >= similarity).groupBy("key", "text_hash", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"), F.col("size").alias("n"))).alias("top")
    )
    return best.select(
        F.col("key").alias(key), "text_hash", "item_id", F.col("top.similarity").alias("similarity"),
        (-F.col("top.s")).cast("long").alias("start"), F.col("top.n").cast("long").alias("n_words"),
    )


def decontaminate(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` in which no benchmark item was found, unchanged.

    ``options`` are those of :func:`contaminated`.
    """
    mark, its_key, its_hash = (spare(df, n) for n in ("mark", "its_key", "its_hash"))
    found = contaminated(df, benchmark, key, text, **options).select(F.col(key).alias(its_key), F.col("text_hash").alias(its_hash)).distinct()
    same = F.col(key).eqNullSafe(F.col(its_key)) & (F.col(mark) == F.col(its_hash))
    return df.withColumn(mark, F.xxhash64(F.col(text))).join(found, same, "left_anti").drop(mark)
