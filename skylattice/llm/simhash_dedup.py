"""Near duplicates by SimHash, linked exactly within three differing bits.

Deletion-variant signatures: a 64-bit fingerprint is cut in two segments of 32
bits. Of two fingerprints at most three bits apart, one segment differs by at
most one bit. So each segment is indexed once as it is and once with each of
its bits wildcarded, 66 keys in all, and fingerprints that meet under a key
are verified. Under a wildcard key only fingerprints that differ in that bit
need to meet; equal segments meet under the plain key.

Only distinct fingerprints are indexed. A key's fingerprints are cut in blocks
of bounded size if there are many, and every pair of blocks is looked at by
one task, which reports a spanning forest of the links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, spare

SHINGLE = 3
SEED = 42
RADIUS = 3
SEGMENT = 32
#: Fingerprints with one segment value that one task compares at a time.
BLOCK = 2048
#: Shingle hashes whose bits are summed at a time.
SUMMED = 1 << 16


def fingerprint_of(text: str | None) -> int:
    """SimHash over word shingles, as a signed 64-bit number.

    Words are separated by ASCII white space; A-Z are lowered.
    """
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    runs = [found] if len(found) < SHINGLE else zip(*[found[k:] for k in range(SHINGLE)])
    n = max(1, len(found) - SHINGLE + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SUMMED):
        bits = np.unpackbits(hashes[at : at + SUMMED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column) -> Column:
    """Fingerprint of each whole text; zero for a null text or one without words."""

    @F.pandas_udf(T.LongType())
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t) for t in batch], dtype="int64")

    return run(text)


def _segments(fps: DataFrame) -> DataFrame:
    value = lambda s: F.shiftrightunsigned("fp", 32 * s).bitwiseAND(2**SEGMENT - 1)
    both = F.array(*[F.struct(F.lit(s).cast("long").alias("segment"), value(s).alias("value")) for s in (0, 1)])
    return fps.select("fp", F.explode(both).alias("s")).select("fp", "s.segment", "s.value")


def _keys(segments: DataFrame) -> DataFrame:
    """Each row once per wildcard, 32 standing for none: key and side, which
    is the value of the wildcarded bit, or 2 under a plain key."""
    rows = segments.withColumn("wild", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SEGMENT).cast("long"))))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("wild").cast("int"))
    plain = F.col("wild") == SEGMENT
    rest = F.when(plain, F.col("value")).otherwise(F.col("value").bitwiseAND(F.bitwise_not(bit)))
    side = F.when(plain, F.lit(2)).when(F.col("value").bitwiseAND(bit) == 0, F.lit(0)).otherwise(F.lit(1))
    key = F.col("segment") * 2**38 + F.col("wild") * 2**32 + rest
    return rows.withColumns({"key": key, "side": side}).drop("wild", "segment", "value")


def _cells(fps: DataFrame, block: int) -> DataFrame:
    """Index rows (cell, side, fp): a key, or a pair of blocks of a key with
    more than ``block`` fingerprints."""
    segments = _segments(fps)
    crowded = segments.groupBy("segment", "value").count().where(F.col("count") > block)
    blocks = _keys(crowded.select(F.ceil(F.col("count") / block).alias("fp"), "segment", "value"))
    blocks = blocks.groupBy("key").agg(
        F.max(F.when(F.col("side") != 1, F.col("fp"))).alias("low"), F.max(F.when(F.col("side") != 0, F.col("fp"))).alias("high")
    )
    rows = _keys(segments).join(cut(blocks), "key", "left")
    low, high = F.coalesce("low", F.lit(1).cast("long")), F.coalesce("high", F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("side") == 1, high).otherwise(low))
    others = F.when(F.col("side") == 0, high).otherwise(low)
    rows = rows.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0).cast("long"), others - 1))})
    one = F.when(F.col("side") == 1, F.col("other")).otherwise(F.col("own"))
    two = F.when(F.col("side") == 1, F.col("own")).otherwise(F.col("other"))
    first = F.when(F.col("side") == 2, F.least(one, two)).otherwise(one)
    second = F.when(F.col("side") == 2, F.greatest(one, two)).otherwise(two)
    split = F.col("low").isNotNull() | F.col("high").isNotNull()
    # two cells of one hash would only be looked at together
    cell = F.when(split, F.xxhash64("key", first, second)).otherwise(F.col("key"))
    return rows.select(cell.alias("cell"), "side", "fp")


def forest(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links (root, member) that join what chains of links within the radius join."""
    todo, links = np.ones(len(fps), dtype=bool), []
    for i in range(len(fps)):
        if not todo[i]:
            continue
        todo[i] = False
        reached = [i]
        while reached:
            near = np.flatnonzero(todo & (np.bitwise_count(fps ^ fps[reached.pop()]) <= RADIUS))
            if len(near):
                todo[near] = False
                reached.extend(near)
                links.append((np.repeat(fps[i], len(near)), fps[near]))
    return links


def links_in_cells(cell: np.ndarray, side: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of whole cells; rows come ordered by cell."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, len(cell)])
    ones = np.add.reduceat((side == 1).astype(np.int64), starts)
    # a wildcard cell needs both values of its bit
    meet = (sizes > 1) & ((side[starts] == 2) | ((ones > 0) & (ones < sizes)))
    two = starts[meet & (sizes == 2)]
    a, b = fp[two], fp[two + 1]
    close = np.bitwise_count(a ^ b) <= RADIUS
    links = [(a[close], b[close])]
    for start, size in zip(starts[meet & (sizes > 2)], sizes[meet & (sizes > 2)]):
        links += forest(np.unique(fp[start : start + size]))
    return links


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] | None = None

    def batch_of(links):
        a = np.concatenate([x for x, _ in links]).view(np.int64)
        b = np.concatenate([y for _, y in links]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        new = [batch.column(c).to_numpy() for c in ("cell", "side", "fp")]
        new[2] = new[2].view(np.uint64)
        rows = new if held is None else [np.concatenate(pair) for pair in zip(held, new)]
        if not len(rows[0]):
            continue
        # the last cell may go on in the next batch
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        held = [r[last:] for r in rows]
        if last:
            yield batch_of(links_in_cells(*[r[:last] for r in rows]))
    if held is not None:
        yield batch_of(links_in_cells(*held))


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect
    exactly what the pairs within the radius connect. Each is such a pair's
    chain inside one cell, so components are the same as with all pairs."""
    rows = _cells(fps, block)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "cell").sortWithinPartitions("cell")
    return rows.mapInArrow(_linked, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is one node
    of its component. Rounds of: take the least neighbour as parent, follow
    parents once more, redraw the edges between parents."""
    edges = cut(edges.where(F.col("a") != F.col("b")))
    nodes = cut(edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct().withColumn("root", F.col("node")))
    while not edges.isEmpty():
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = ways.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("x"), F.least("a", "p").alias("p"))
        above = parents.select(F.col("x").alias("y"), F.col("p").alias("q"))
        parents = cut(parents.join(above, F.col("p") == F.col("y"), "left").select("x", F.coalesce("q", "p").alias("p")))
        nodes = cut(nodes.join(parents, F.col("root") == F.col("x"), "left").select("node", F.coalesce("p", "root").alias("root")))
        up = lambda end: parents.select(F.col("x").alias(end), F.col("p").alias(f"p_{end}"))
        moved = edges.join(up("a"), "a").join(up("b"), "b").where(F.col("p_a") != F.col("p_b"))
        edges = cut(moved.select(F.least("p_a", "p_b").alias("a"), F.greatest("p_a", "p_b").alias("b")).distinct())
    return nodes


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: the key, ``fp`` (signed), ``component_id``.

    The component is the least non-null key that can be reached by steps of at
    most three differing bits, the row's own included; null if all are null.
    Null texts and texts without words have fingerprint zero and are linked
    like any others. An empty table gives no rows.
    """
    prints = cut(df.select(F.col(key).alias("key"), fingerprint(F.col(text)).alias("fp")))
    classes = cut(prints.groupBy("fp").agg(F.min("key").alias("least")))
    found = components(links(classes.select("fp"), block))
    rooted = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    merged = rooted.join(found.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("together"))
    named = rooted.join(merged, "root", "left").select("fp", F.coalesce("together", "least").alias("component_id"))
    return prints.join(named, "fp").select(F.col("key").alias(key), "fp", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each component: the one of the least key, of rows
    with that key the one whose content has the least hash. Columns and rows
    kept are unchanged; of fully equal rows one stays. In a component without
    any key the least content hash stays."""
    mark, k, h = (spare(df, n) for n in ("mark", "k", "h"))
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    marked = df.withColumn(mark, content)
    rows = marked.select(F.struct(F.col(key).alias("k"), F.col(mark).alias("h")).alias("id"), F.col(text).alias("text"))
    grouped = near_duplicates(rows, "id", "text")
    winners = grouped.select(F.col("component_id.k").alias(k), F.col("component_id.h").alias(h)).distinct()
    same = F.col(key).eqNullSafe(F.col(k)) & (F.col(mark) == F.col(h))
    kept = marked.join(winners, same, "left_semi")
    return kept.dropDuplicates([key, mark]).drop(mark)
