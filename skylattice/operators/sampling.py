"""Samples and splits that repeat: every choice is a hash of the row's id.

Exact sizes come from exact ranks along the hash, found without gathering a
class in one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import keyed_number, run_lengths
from ..ordered import OrderedRows, attach, index_rows
from ..session import materialise


def hash_unit(ids: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) from the id."""
    return keyed_number(*ids, seed=seed).cast("double") / F.lit(float(2**60))


def sample_fraction(df: DataFrame, ids: Sequence[str], fraction: float, seed: int) -> DataFrame:
    return df.where(hash_unit(ids, seed) < fraction)


def _ranked(df: DataFrame, keys: Sequence[str], ids: Sequence[str], seed: int) -> DataFrame:
    hashed = df.withColumn("__h", keyed_number(*ids, seed=seed))
    return OrderedRows(hashed, keys, ["__h", *ids]).row_number("__rank").finish().drop("__h")


def sample_with_replacement(df: DataFrame, ids: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows drawn with replacement; ``draw`` numbers them.

    Each draw is a hashed row number, drawn ones are counted per row number
    and joined to the numbered table.
    """
    numbered = OrderedRows(df, [], ids).row_number("__row").finish()
    size = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"), (keyed_number("id", seed=seed) % size + 1).alias("__row")
    )
    return draws.join(numbered, "__row").drop("__row")


#: Rows of a chunk, about; and children of a node of the tree above the chunks.
CHUNK_ROWS = 20_000
FAN_BITS = 6


def _split_draws(n: int, sizes: list[int], *key) -> list[int]:
    """``n`` draws dealt to parts in proportion to their sizes: a chain of
    binomials, each of what is left, from numbers keyed by ``key``."""
    rng = np.random.default_rng(int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest(), 16))
    total = sum(sizes)
    return rng.multinomial(n, [s / total for s in sizes]).tolist() if total else [0] * len(sizes)


def _draws_by_chunk(sizes: DataFrame, n: int, seed: int, bits: int) -> DataFrame:
    """(chunk, draws) from (chunk, m): ``n`` is split down a tree over the bits
    of the chunk's number, a few bits at a level."""
    steps = [*range(0, bits, FAN_BITS), bits]
    level = sizes.groupBy(F.lit(0).cast("long").alias("node")).agg(F.sum("m").alias("m")).withColumn("draws", F.lit(n).cast("long"))

    @F.udf("array<bigint>")
    def deal(draws: int, node: int, depth: int, below: list[int]) -> list[int]:
        return _split_draws(draws, below, seed, depth, node)

    for above, here in zip(steps, steps[1:]):
        children = sizes.groupBy(F.shiftright("chunk", bits - here).alias("child")).agg(F.sum("m").alias("m"))
        children = children.withColumn("node", F.shiftright("child", here - above))
        # at most 2 ** FAN_BITS children a node
        gathered = children.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("child", "m"))).alias("below"))
        dealt = level.select("node", "draws").join(gathered, "node")
        dealt = dealt.withColumn("parts", deal("draws", "node", F.lit(above), F.col("below.m")))
        level = materialise(dealt.select(F.inline(F.arrays_zip(F.col("below.child").alias("node"), F.col("below.m").alias("m"), F.col("parts").alias("draws")))))
    return level.select(F.col("node").alias("chunk"), "draws")


def draw_counts(df: DataFrame, ids: Sequence[str], n: int, seed: int, out: str = "drawn", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """How often each row is drawn when exactly ``n`` rows are drawn with
    replacement; rows that are not drawn are left out.

    A row's chunk is the head of a number keyed by its id. The draws are split
    over the chunks by keyed binomials, and each chunk deals its own to its
    rows, in the order of number and id: no draw meets a row by a join, and
    nothing depends on how the rows are spread over tasks. Rows with equal
    ids are rows of their own. An empty table gives no rows.
    """
    numbered = df.withColumn("__number", keyed_number(*ids, seed=seed))
    size = df.count()
    bits = max(0, math.ceil(math.log2(max(1, size) / chunk_rows)))
    chunked = numbered.withColumn("__chunk", F.shiftright("__number", 60 - bits))
    sizes = materialise(chunked.groupBy(F.col("__chunk").alias("chunk")).agg(F.count(F.lit(1)).alias("m")))
    draws = _draws_by_chunk(sizes, n, seed, bits).where(F.col("draws") > 0).withColumnRenamed("chunk", "__chunk")
    shape = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    names, order = df.columns, ["__number", *ids]

    def deal(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in order])
        counts = np.array(_split_draws(rows["draws"][0].as_py(), [1] * len(rows), seed, "rows", rows["__chunk"][0].as_py()))
        hit = pa.array(np.flatnonzero(counts))
        return rows.select(names).take(hit).append_column(out, pa.array(counts[counts > 0]))

    return attach(chunked, draws, ["__chunk"], "inner").groupBy("__chunk").applyInArrow(deal, shape)


def resample(df: DataFrame, ids: Sequence[str], n: int, seed: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement, each as often as it was drawn."""
    counts = draw_counts(df, ids, n, seed, "__drawn", chunk_rows)
    return index_rows(counts, F.col("__drawn"), "__copy").drop("__drawn", "__copy")


def stratified_sets(
    df: DataFrame, label: str, ids: Sequence[str], test: float, validation: float, seed: int, out: str = "part"
) -> DataFrame:
    """Test and validation rows as fixed fractions of every class.

    Both fractions are of the full class size, rounded down; the rest is
    training.
    """
    ranked = _ranked(df, [label], ids, seed)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__size"))
    rows = attach(ranked, sizes, [label])
    n_test = F.floor(F.col("__size") * F.lit(test))
    n_val = F.floor(F.col("__size") * F.lit(validation))
    part = (
        F.when(F.col("__rank") <= n_test, "test")
        .when(F.col("__rank") <= n_test + n_val, "validation")
        .otherwise("train")
    )
    return rows.withColumn(out, part).drop("__rank", "__size")


def undersample(
    df: DataFrame, label: str, minority, ids: Sequence[str], fraction: float, seed: int
) -> DataFrame:
    """All minority rows, a fraction of the others, in shuffled order."""
    keep = (F.col(label) == F.lit(minority)) | (hash_unit(ids, seed) < fraction)
    return df.where(keep).orderBy(keyed_number(*ids, seed=seed + 1), *ids)


def class_weights(df: DataFrame, label: str, out: str = "weight", balanced: bool = False) -> DataFrame:
    """Weight ``1 / (n_class / n) / 2``; balanced divides by the class count
    instead of 2. Class sizes are counted before they meet the rows."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    parts = df.agg(F.count_distinct(label).alias("n")).scalar() if balanced else F.lit(2)
    weights = sizes.select(label, (total / F.col("__n") / parts).alias(out))
    return attach(df, weights, [label])


def split_random(df: DataFrame, ids: Sequence[str], train: float, seed: int) -> DataFrame:
    return df.withColumn("part", F.when(hash_unit(ids, seed) < train, "train").otherwise("test"))


def split_by_group(df: DataFrame, group: Sequence[str], train: float, seed: int) -> DataFrame:
    """All rows of a group on one side. The side is a hash of the group key, so
    no group table is built and nothing is shuffled."""
    return split_random(df, group, train, seed)


def split_by_time(df: DataFrame, ts: str, at: str) -> DataFrame:
    """Before or after a moment; rows at the moment itself are dropped."""
    moment = F.lit(at).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) != moment).withColumn("part", F.when(F.col(ts) < moment, "train").otherwise("test"))


def split_ordered(df: DataFrame, order: Sequence[str], train: float) -> DataFrame:
    """The first share of the rows in ``order`` and the rest."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = OrderedRows(df, [], order).row_number("__pos").finish()
    cut = F.floor(total * F.lit(train))
    return rows.withColumn("part", F.when(F.col("__pos") <= cut, "train").otherwise("test")).drop("__pos")


def with_fold(df: DataFrame, ids: Sequence[str], folds: int, seed: int, out: str = "fold") -> DataFrame:
    return df.withColumn(out, (keyed_number(*ids, seed=seed) % folds).cast("int"))


def rle_pixels(df: DataFrame, encoded: str, height: str, keys: Sequence[str], max_run: int = 100_000) -> DataFrame:
    """Run-length mask ("start length ...", 1-based) to one row per pixel.

    Pixel ``i = start - 1 + k``; ``x = i div height``, ``y = i mod height``.
    Long runs are cut in pieces before they are written out.
    """
    runs = df.select(*keys, height, F.explode(run_lengths(F.col(encoded))).alias("__r")).where(F.col("__r.length") > 0)
    last = F.floor((F.col("__r.length") - 1) / max_run)
    pieces = runs.withColumn("__p", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("__r.start") - 1 + F.col("__p") * max_run
    stop = F.least(F.col("__r.start") - 2 + F.col("__r.length"), start + max_run - 1)
    pixels = pieces.withColumn("__i", F.explode(F.sequence(start, stop)))
    return pixels.select(
        *keys,
        F.floor(F.col("__i") / F.col(height)).cast("long").alias("x"),
        (F.col("__i") % F.col(height)).cast("long").alias("y"),
    )


def pure_tiles(pixels: DataFrame, image: str, label: str, size: int) -> DataFrame:
    """Grid-aligned tiles filled by one label.

    ``pixels`` has rows (image, label, x, y); a repeated pixel counts once.
    Each task counts its own pixels first, so a large image is not gathered.
    ``tiles.grid_tiles`` does the same from runs, without pixels.
    """
    return (
        pixels.select(image, label, "x", "y")
        .distinct()
        .groupBy(
            image, label, F.floor(F.col("x") / size).cast("long").alias("tile_x"), F.floor(F.col("y") / size).cast("long").alias("tile_y")
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == size * size)
        .drop("n")
    )
