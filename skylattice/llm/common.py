"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    The shuffle files of the write are removed when it is done, so that only
    one step's files are on disk at a time.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return materialise(df)
    finally:
        conf.set(_CLEANUP, before)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Words of a text; of a null text none.

    Blanks are made equal first, so that the split is on one character.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def number_rows(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with the global row number from 0 along ``order`` in ``out``.

    Rows are dealt by range, sorted, written with their place in their
    partition, and moved up by the sizes of the partitions before. Equal keys
    are cut too: the last key is the row's place in the input. So the number
    does not depend on the partitioning, except among rows equal in ``order``.
    """
    salt, place, part, before = (spare(df, n) for n in ("salt", "place", "part", "before"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col(salt)]
    dealt = df.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # partition number above bit 33, place in the partition below
    rows = cut(dealt.drop(salt).withColumn(place, F.monotonically_increasing_id()).withColumn(part, F.shiftright(place, 33)))
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    starts = sizes.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    numbered = rows.join(F.broadcast(starts), part)
    return numbered.withColumn(out, F.col(before) + F.col(place).bitwiseAND(2**33 - 1)).drop(place, part, before)
