"""Tables of places, written so that a box reads few of their row groups.

Each coordinate is cut in 2^BITS steps between its ends, and the bits of the
steps are interleaved into one key: places that are near have keys that share
their heads. Rows are written in the order of the key. A box is a few dozen
ranges of keys; they are pushed to the scan as predicates, and a row group
whose least and greatest key meet no range is skipped.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "place_key"
#: Steps of a coordinate are 2 ** BITS; keys of two or three coordinates fit in 63 bits.
BITS = 20
#: Bits of a step that are spread out at once.
LOOKED_UP = 5
#: Ranges of keys that a box is put into at most.
MOST_RANGES = 48


def interleaved(steps: Sequence[Column], bits: int = BITS) -> Column:
    """One key of the bits of several whole numbers, the highest ones first."""
    if len(steps) * bits > 63:
        raise ValueError("the bits of all coordinates must fit in a long")
    n = len(steps)
    # a few bits at a time with the gaps between them; an operation per bit makes code too long to be compiled
    apart = F.array(*[F.lit(sum((v >> b & 1) << b * n for b in range(LOOKED_UP))).cast("long") for v in range(2**LOOKED_UP)])
    key = F.lit(0).cast("long")
    for b in range(0, bits, LOOKED_UP):
        for k, step in enumerate(steps):
            some = F.shiftright(step.cast("long"), b).bitwiseAND(F.lit(2 ** min(LOOKED_UP, bits - b) - 1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(F.get(apart, some.cast("int")), b * n + k))
    return key


def step_of(value: Column, low: float, high: float, bits: int = BITS) -> Column:
    """The step a coordinate falls in; values beyond the ends fall in the last ones."""
    share = (value.cast("double") - F.lit(low)) / F.lit((high - low) or 1.0)
    return F.least(F.greatest(F.floor(share * 2**bits), F.lit(0)), F.lit(2**bits - 1)).cast("long")


def _step(value: float, low: float, high: float, bits: int) -> int:
    share = (value - low) / ((high - low) or 1.0)
    return min(max(int(share * 2**bits // 1), 0), 2**bits - 1)


def ranges(box: Sequence[tuple[int, int]], bits: int = BITS, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Ranges of keys that hold all places of a box of steps (ends included).

    The space is halved along one coordinate after the other. What lies wholly
    inside is one range; what lies across is halved again, the largest first,
    until there are ``most``, and then taken whole. So nothing is missed, and
    what is read in vain gets less with every range.
    """
    n = len(box)
    todo = [(n * bits, 0, tuple((0, 2**bits - 1) for _ in box))]
    done: list[tuple[int, int]] = []
    while todo and len(todo) + len(done) < most:
        todo.sort()
        left, key, sides = todo.pop()
        if any(hi < a or lo > b for (lo, hi), (a, b) in zip(sides, box)):
            continue
        if left == 0 or all(a <= lo and hi <= b for (lo, hi), (a, b) in zip(sides, box)):
            done.append((key, key + 2**left - 1))
            continue
        k = (left - 1) % n
        lo, hi = sides[k]
        middle = (lo + hi) // 2
        for upper, side in ((0, (lo, middle)), (1, (middle + 1, hi))):
            todo.append((left - 1, key + upper * 2 ** (left - 1), (*sides[:k], side, *sides[k + 1 :])))
    for left, key, sides in todo:
        if not any(hi < a or lo > b for (lo, hi), (a, b) in zip(sides, box)):
            done.append((key, key + 2**left - 1))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(done):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def write_places(df: DataFrame, path: str, coordinates: Sequence[str], files: int | None = None, row_group_bytes: int | None = None) -> None:
    """Write ``df`` in the order of its places, with the key in ``place_key``.

    The ends of the coordinates are those of the data and are kept with the
    table. A row without a coordinate has no key and is in no box.
    """
    ends = df.agg(*[f(F.col(c).cast("double")).alias(f"{i}{n}") for i, c in enumerate(coordinates) for n, f in (("a", F.min), ("b", F.max))]).first()
    limits = [(float(ends[f"{i}a"] or 0.0), float(ends[f"{i}b"] or 0.0)) for i in range(len(coordinates))]
    # steps are columns, so that they are worked out once and not for every look-up
    steps = {f"__step_{i}": step_of(F.col(c), *limit) for i, (c, limit) in enumerate(zip(coordinates, limits))}
    key = interleaved([F.col(s) for s in steps])
    known = F.lit(True)
    for c in coordinates:
        known = known & F.col(c).isNotNull()
    kept = {"places": json.dumps({"coordinates": list(coordinates), "limits": limits, "bits": BITS})}
    keyed = df.withColumns(steps).select(*df.columns, F.when(known, key).alias(KEY, metadata=kept))
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = keyed.repartitionByRange(n, KEY, *coordinates).sortWithinPartitions(KEY, *coordinates).write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", 1000)
    writer.parquet(path)


def read_box(spark: SparkSession, path: str, box: dict[str, tuple[float, float]], most: int = MOST_RANGES) -> DataFrame:
    """The rows of a table of places with every coordinate of ``box`` between
    its ends (included); coordinates that are not named may have any value."""
    table = spark.read.parquet(path)
    layout = json.loads(table.schema[KEY].metadata["places"])
    if unknown := set(box) - set(layout["coordinates"]):
        raise ValueError(f"not a coordinate of this table: {sorted(unknown)}")
    bits, steps = layout["bits"], []
    for c, (low, high) in zip(layout["coordinates"], layout["limits"]):
        a, b = box.get(c, (low, high))
        steps.append((_step(a, low, high, bits), _step(b, low, high, bits)))
    near = F.lit(False)
    for a, b in ranges(steps, bits, most):
        near = near | F.col(KEY).between(a, b)
    rows = table.where(near)
    for c, (a, b) in box.items():
        rows = rows.where(F.col(c).between(a, b))
    return rows.drop(KEY)
