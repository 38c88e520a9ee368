"""Order-dependent work without ever holding a whole group in one task.

``Window.partitionBy(series)`` sends a series to one task. A series may hold a
third of all rows, so scans here cut the rows of all series, in order, in even
partitions, work on each alone and carry one row per partition over the
borders (``OrderedRows``). Quantiles are bracketed by mergeable sketches, and
only the values in a bracket are put in order.

Only the balance is approximate; every result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import materialise

BROADCAST_ROWS = 200_000


def default_chunks(df: DataFrame) -> int:
    """As many chunks as the session has shuffle partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which equal nulls match; the right keys are dropped."""
    names = {k: f"__rk{i}" for i, k in enumerate(keys)}
    on = F.lit(True)
    for k, other in names.items():
        on = on & F.col(k).eqNullSafe(F.col(other))
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())


class OrderedRows:
    """Scans over the rows of every group in a total order.

    Rows are dealt by range of the whole key - group, order, and a tie breaker
    of the row's own - and sorted, so partitions are even however few order
    values, nulls or groups there are. One pass over each partition finds what
    can be found inside it. Only the group that a partition begins with can
    hang on rows before it (the group it ends with on rows behind it), so one
    summary row per partition carries the rest, and goes to all tasks: as many
    rows as there are partitions.

    Steps are named first and done together by :meth:`finish`. Equal rows may
    change places; nulls in group columns are a group, nulls in order columns
    come first.
    """

    def __init__(self, df: DataFrame, group: Sequence[str], order: Sequence[str], n_parts: int | None = None):
        self.df, self.group, self.order = df, list(group), list(order)
        self.n_parts = n_parts or default_chunks(df)
        self.number: str | None = None
        self.fills: list[Fill] = []
        self.taken = {c.lower() for c in df.columns}

    def _name(self, name: str) -> str:
        while name.lower() in self.taken:
            name = f"_{name}"
        self.taken.add(name.lower())
        return name

    def row_number(self, out: str = "row_no") -> "OrderedRows":
        """1-based position in the group."""
        self.number = out
        return self

    def previous(self, columns: dict[str, str], forward: bool = False) -> "OrderedRows":
        """Values of the row just before (after, if ``forward``) this one.

        ``columns`` maps source column to output column.
        """
        row = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
        self.fills.append(Fill(row, {out: f"v{i}" for i, out in enumerate(columns.values())}, forward, True))
        return self

    def nearest_known(
        self, columns: dict[str, tuple[Column, Column, bool]], places: dict[str, str] | None = None, strict: bool = False
    ) -> "OrderedRows":
        """Nearest row, this one included unless ``strict``, at which a condition holds.

        ``columns`` maps an output to (value, condition, forward): looking
        back for ``forward`` False, ahead for True. ``places`` maps outputs
        to columns for the position of that row in its group.
        """
        for out, (value, condition, forward) in columns.items():
            row = F.when(condition, F.struct(value.alias("v")))
            self.fills.append(Fill(row, {out: "v"}, forward, strict, (places or {}).get(out)))
        return self

    def parts(self) -> tuple[DataFrame, str]:
        """The rows dealt by range and sorted, and the column that numbers
        them: the partition above bit 33, the place in it below."""
        at, salt, first = self._name("__at"), self._name("__salt"), self._name("__hash")
        content = [c for c, kind in self.df.dtypes if "map<" not in kind and "variant" not in kind]
        keys = [*self.group, *self.order, first, salt]
        marked = self.df.withColumns({first: F.xxhash64(*content), salt: F.monotonically_increasing_id()})
        rows = marked.repartitionByRange(self.n_parts, *keys).sortWithinPartitions(*keys).drop(first, salt)
        return rows.withColumn(at, F.monotonically_increasing_id()), at

    def finish(self) -> DataFrame:
        """The rows with the outputs of all steps."""
        rows, at = self.parts()
        columns = list(self.df.columns)
        counted = self.number is not None or any(f.place for f in self.fills)
        pos, head = self._name("__pos"), {fwd: self._name(f"__head_{int(fwd)}") for fwd in (False, True)}
        local = [self._name(f"__found_{k}") for k in range(len(self.fills))]
        if not self.group and not self.fills:
            # all rows are one group: the place in the partition is enough
            rows = rows.withColumns({pos: F.col(at).bitwiseAND(_PLACE) + 1, head[False]: F.lit(True)})
            ways = [False]
        else:
            ways = [False, True] if any(f.forward for f in self.fills) else [False]
            for way in ways:
                mine = [k for k, f in enumerate(self.fills) if f.forward == way]
                own = {local[k]: self.fills[k].row for k in mine}
                rows = rows.withColumns(own) if own else rows
                if way:
                    rows = rows.sortWithinPartitions(F.desc(at))
                run = _Pass(self.group, [(local[k], self.fills[k].strict, bool(self.fills[k].place)) for k in mine], pos, head[way], way)
                rows = rows.mapInArrow(run, run.schema(rows.schema))
        part = self._name("__part")
        table = materialise(rows).withColumn(part, F.shiftright(at, 33))
        carried = self._carries(table, part, at, pos, head, local, ways)
        done = table.join(F.broadcast(carried), part)
        offset = F.when(F.col(head[False]), F.col("__c_n")).otherwise(F.lit(0).cast("long"))
        outputs = {}
        if self.number is not None:
            outputs[self.number] = F.col(pos) + offset
        for k, f in enumerate(self.fills):
            here, there = F.col(local[k]), F.when(F.col(head[f.forward]), F.col(f"__c_{k}"))
            for out, field in f.outputs.items():
                outputs[out] = F.when(here.isNotNull(), here["row"][field]).otherwise(there["row"][field])
            if f.place:
                outputs[f.place] = F.when(here.isNotNull(), here["place"] + offset).otherwise(there["place"])
        kept = [F.col(c) for c in columns if c not in outputs]
        return done.select(*kept, *[c.alias(n) for n, c in outputs.items()])

    def _carries(self, table, part, at, pos, head, local, ways) -> DataFrame:
        """For each partition what the group it begins with has before it, and
        the group it ends with behind it. Windows here run over one row per
        partition."""
        key = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(self.group)]) if self.group else F.struct(F.lit(0).alias("g0"))
        seen = []
        for k, f in enumerate(self.fills):
            # what the outermost row has, itself included
            own = F.when(f.row.isNotNull(), F.struct(f.row.alias("row"), (F.col(pos) if f.place else F.lit(None).cast("long")).alias("place")))
            value = F.coalesce(own, F.col(local[k])) if f.strict else F.col(local[k])
            seen.append((F.min_by if f.forward else F.max_by)(value, at).alias(f"__e_{k}"))
        ends = table.groupBy(part).agg(
            F.min_by(key, at).alias("__first"), F.max_by(key, at).alias("__last"), F.max_by(F.col(pos), at).alias("__n"), *seen
        )
        for way in ways:
            enters, leaves = ("__last", "__first") if way else ("__first", "__last")
            along = Window.orderBy(F.desc(part) if way else F.asc(part))
            goes_on = F.coalesce(F.col(enters).eqNullSafe(F.lag(leaves).over(along)), F.lit(False))
            ends = ends.withColumn("__on", goes_on)
            # partitions that end with one and the same group
            new = F.when(F.col("__on") & F.col("__first").eqNullSafe(F.col("__last")), 0).otherwise(1)
            ends = ends.withColumn("__run", F.sum(new).over(along))
            upto = Window.partitionBy("__run").orderBy(F.desc(part) if way else F.asc(part)).rowsBetween(Window.unboundedPreceding, 0)
            before = lambda c: F.when(F.col("__on"), F.lag(c).over(along))
            if not way:
                ends = ends.withColumn("__s_n", F.sum("__n").over(upto)).withColumn("__c_n", F.coalesce(before("__s_n"), F.lit(0)))
            for k, f in enumerate(self.fills):
                if f.forward != way:
                    continue
                found = F.col(f"__e_{k}")
                if f.place:
                    # partitions count from their own first row; what a partition
                    # shows to the one before it lies in the group it begins with
                    whole = F.col("__first").eqNullSafe(F.col("__last"))
                    moved = F.when(F.lit(way) | whole, F.col("__c_n")).otherwise(F.lit(0))
                    found = F.when(found.isNotNull(), F.struct(found["row"].alias("row"), (found["place"] + moved).alias("place")))
                ends = ends.withColumn(f"__s_{k}", F.last(found, ignorenulls=True).over(upto))
                ends = ends.withColumn(f"__c_{k}", before(f"__s_{k}"))
        # one row per partition; written, as the windows above need one task
        return materialise(ends.select(part, "__c_n", *[f"__c_{k}" for k in range(len(self.fills))]))


@dataclass
class Fill:
    """A row (struct, null where there is nothing) that the rows behind it take
    until the next one, its fields by output, and how it is looked for."""

    row: Column
    outputs: dict[str, str]
    forward: bool
    strict: bool
    place: str | None = None


#: Bits of a row's place in its partition.
_PLACE = 2**33 - 1


class _Pass:
    """One pass over a sorted partition, batch by batch.

    Adds the position in the group, as far as the partition knows it, whether
    the row's group is the one the partition begins with, and replaces each
    fill's struct by the last one before (or at) the row. What is kept from
    batch to batch is one row.
    """

    def __init__(self, group: list[str], fills: list[tuple[str, bool, bool]], pos: str, head: str, backward: bool):
        self.group, self.fills, self.pos, self.head, self.backward = group, fills, pos, head, backward

    def schema(self, before: T.StructType) -> T.StructType:
        fields = []
        names = {name for name, _, _ in self.fills}
        for f in before.fields:
            wide = T.StructType([T.StructField("row", f.dataType), T.StructField("place", T.LongType())])
            fields.append(T.StructField(f.name, wide if f.name in names else f.dataType))
        if not self.backward:
            fields.append(T.StructField(self.pos, T.LongType()))
        return T.StructType([*fields, T.StructField(self.head, T.BooleanType())])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.Array] | None = None
        kept: dict[str, pa.Array] = {}
        count, in_head = 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(batch.schema.get_field_index(g)) for g in self.group]
            new = np.zeros(n, dtype=bool)
            for k, column in enumerate(keys):
                new[1:] |= differs(column.slice(0, n - 1), column.slice(1))
                if last is not None:
                    new[:1] |= differs(last[k], column.slice(0, 1))
            last = [column.slice(n - 1) for column in keys]
            place = np.arange(n)
            # where the row's group begins in this batch; -1 if before it
            begin = np.maximum.accumulate(np.where(new, place, -1))
            heads = (begin < 0) & in_head
            in_head = bool(heads[-1])
            columns = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            if not self.backward:
                columns[self.pos] = pa.array(np.where(begin < 0, count + place + 1, place - begin + 1))
                count = int(n + count if begin[-1] < 0 else n - begin[-1])
            for name, strict, placed in self.fills:
                columns[name] = self._filled(columns, name, strict, placed, begin, kept)
            columns[self.head] = pa.array(heads)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    def _filled(self, columns, name: str, strict: bool, placed: bool, begin: np.ndarray, kept: dict[str, pa.Array]) -> pa.Array:
        row, n = columns[name], len(begin)
        number = columns[self.pos] if placed else pa.nulls(n, pa.int64())
        valid = row.is_valid().to_numpy(zero_copy_only=False)
        own = pa.StructArray.from_arrays([row, number], names=["row", "place"], mask=pa.array(~valid))
        before = kept.get(name, pa.nulls(1, own.type))
        known = np.maximum.accumulate(np.where(valid, np.arange(n), -1))
        # 0 is what an earlier batch has left, which is for its last group alone
        at = lambda k: np.where(k >= np.maximum(begin, 0), k + 1, np.where(begin < 0, 0, -1))
        seen = at(np.concatenate([[-1], known[:-1]])) if strict else at(known)
        both = pa.concat_arrays([before, own])
        end = at(known)[-1:]
        kept[name] = both.take(pa.array(end, mask=end < 0))
        return both.take(pa.array(seen, mask=seen < 0))


def differs(one: pa.Array, two: pa.Array) -> np.ndarray:
    """Where two columns are not the same value; nulls and NaNs equal themselves."""
    same = pc.fill_null(pc.equal(one, two), False)
    same = pc.or_(same, pc.and_(one.is_null(), two.is_null()))
    if pa.types.is_floating(one.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(one), pc.is_nan(two)), False))
    return ~same.to_numpy(zero_copy_only=False)


def index_rows(df: DataFrame, n: Column, out: str, per_row: int = 10_000) -> DataFrame:
    """Every row ``n`` times, numbered from 0 in ``out``.

    Numbers are made in pieces that are spread over the tasks first, so a
    large ``n`` is never one array.
    """
    counted = df.withColumn("__n", n.cast("long")).where(F.col("__n") > 0)
    pieces = counted.withColumn(
        "__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / per_row)))
    ).repartition("__piece")
    first = F.col("__piece") * per_row
    last = F.least(first + per_row, F.col("__n")) - 1
    return pieces.withColumn(out, F.explode(F.sequence(first, last))).drop("__n", "__piece")


def bounded_frame(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    reach: int,
    outputs: dict,
    n_chunks: int | None = None,
    block_rows: int = 500_000,
) -> DataFrame:
    """Window functions over the last ``reach`` rows and the current one.

    Rows get their exact position, are put in blocks of ``block_rows`` rows
    and the last ``reach`` rows of a block are copied to the next one, so each
    block can be worked on alone. ``outputs`` maps a column name to a function
    of the ordered window (``Window`` spec without frame) giving a column.
    """
    block_rows = max(block_rows, 2 * reach)
    pos = OrderedRows(df, group, order, n_chunks).row_number("__pos").finish()
    home = F.floor((F.col("__pos") - 1) / block_rows)
    tail = ((F.col("__pos") - 1) % block_rows) >= block_rows - reach
    copies = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    blocks = pos.withColumn("__home", home).withColumn("__block", F.explode(copies))
    w = Window.partitionBy(*group, "__block").orderBy("__pos")
    blocks = blocks.select("*", *[make(w).alias(name) for name, make in outputs.items()])
    return blocks.where(F.col("__block") == F.col("__home")).drop("__block", "__home", "__pos")


#: Size of a quantile sketch, and the error of its ranks (as a share of the
#: values) that is allowed for: twice what it keeps to in 99 of 100 cases.
SKETCH = 2048
RANK_ERROR = 2 * 2.296 / SKETCH**0.9021
#: Steps in which a sketch is read.
GRID = 512
#: Distinct values of a group that are put in order together for one rank.
ORDERED_VALUES = 500_000
#: After as many rounds a bracket is put in order as it is.
MOST_ROUNDS = 8


def _values(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    known = df.select(*group, F.col(value).alias("__v"), F.col(value).cast("double").alias("__d"))
    return known.where(F.col("__d").isNotNull() & ~F.isnan("__d"))


def quantile_sketches(df: DataFrame, group: Sequence[str], value: str, out: str = "sketch") -> DataFrame:
    """A sketch of each group's values. Sketches of parts of a group (days,
    files) can be kept and put together by :func:`merged_sketches`."""
    return _values(df, group, value).groupBy(*group).agg(F.kll_sketch_agg_double("__d", F.lit(SKETCH)).alias(out))


def merged_sketches(parts: DataFrame, group: Sequence[str], sketch: str = "sketch") -> DataFrame:
    return parts.groupBy(*group).agg(F.kll_merge_agg_double(sketch).alias(sketch))


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float], most: int = ORDERED_VALUES, sketches: DataFrame | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (group, prob).

    A sketch of each group brackets the ranks that are wanted. One more pass
    counts values outside all brackets, and equal ones inside them together,
    before the shuffle; only what is inside a bracket is put in order. A
    bracket with more than ``most`` distinct values is sketched again, from
    its own values, and one that missed its rank (a sketch errs by chance) is
    opened to the ends: the result is exact whatever the sketch.

    ``sketches`` (group, sketch) may be given if there are some already. Nulls
    and NaNs are no values; a group without any has no row.
    """
    group, probs = list(group), sorted({float(p) for p in probs})
    known = _values(df, group, value)
    held = sketches if sketches is not None else quantile_sketches(df, group, value)
    ranks = range(2 * len(probs))
    n = F.kll_sketch_get_n_double("sketch")
    at = lambda r: F.lit(probs[r // 2]) * (F.col("n") - 1).cast("double")
    rank = [(F.ceil(at(r)) if r % 2 else F.floor(at(r))).cast("long").alias(f"rank{r}") for r in ranks]
    base = held.select(*group, _grid("sketch").alias("grid"), n.alias("n")).select("*", *rank)
    ends = {f"{e}{r}": _end(F.col(f"rank{r}"), F.col("n"), e == "hi") for r in ranks for e in ("lo", "hi")}
    wanted = materialise(base.select(*group, "n", *[f"rank{r}" for r in ranks], *[c.alias(k) for k, c in ends.items()]))
    counted = materialise(_counted(known, wanted, group, ranks))
    inside = counted.where("a > c").withColumn("r", F.explode(F.sequence(F.col("c"), F.col("a") - 1))).select(*group, "r", "__v", "m")
    asked = F.array(*[F.struct(F.lit(r).alias("r"), F.col(f"rank{r}").alias("rank"), F.col(f"lo{r}").alias("lo"), F.col(f"hi{r}").alias("hi")) for r in ranks])
    brackets = wanted.select(*group, F.inline(asked))
    early = [F.sum(F.when(F.col("a") <= r, F.col("m")).otherwise(F.lit(0).cast("long"))).alias(f"b{r}") for r in ranks]
    before = counted.groupBy(*group).agg(*early)
    before = before.select(*group, F.inline(F.array(*[F.struct(F.lit(r).alias("r"), F.col(f"b{r}").alias("before")) for r in ranks])))
    by, found = [*group, "r"], None
    for turn in range(MOST_ROUNDS):
        state = materialise(_state(brackets, before, inside, by))
        ready = (F.col("inside") <= most) | F.lit(turn == MOST_ROUNDS - 1)
        run = Window.partitionBy(*by).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
        chosen = join_null_safe(inside, state.where(F.col("hit") & ready).select(*by, "rank", "before"), by, "inner")
        chosen = chosen.withColumn("end", F.sum("m").over(run) + F.col("before"))
        here = (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("m"))
        picked = materialise(chosen.where(here).select(*by, "__v"))
        found = picked if found is None else found.unionByName(picked)
        left = state.where(~(F.col("hit") & ready))
        if left.isEmpty():
            break
        brackets = materialise(_narrowed(known, left, group, by))
        low, high = F.coalesce(F.col("__d") < F.col("lo"), F.lit(False)), F.coalesce(F.col("__d") > F.col("hi"), F.lit(False))
        seen = attach(known, brackets, group, "inner").where(~high)
        counted = materialise(seen.groupBy(*by, F.when(~low, F.col("__v")).alias("__v")).agg(F.count(F.lit(1)).alias("m")))
        before, inside = counted.where(F.col("__v").isNull()).select(*by, F.col("m").alias("before")), counted.where(F.col("__v").isNotNull())
    sides = [F.max(F.when(F.col("r") == r, F.col("__v"))).alias(f"v{r}") for r in ranks]
    values = join_null_safe(wanted.select(*group, "n"), found.groupBy(*group).agg(*sides), group)
    rows = []
    for k, p in enumerate(probs):
        low, high, share = F.col(f"v{2 * k}"), F.col(f"v{2 * k + 1}"), at(2 * k) - F.floor(at(2 * k))
        rows.append(F.struct(F.lit(p).alias("prob"), F.when(low == high, low.cast("double")).otherwise(low + (high - low) * share).alias("quantile")))
    return values.select(*group, F.inline(F.array(*rows)))


def _grid(sketch: str) -> Column:
    """Values at even shares of a sketch."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))


def _end(rank: Column, n: Column, high: bool) -> Column:
    """An end of the bracket of a rank, from the column ``grid``; null if it is open."""
    share = (rank + 1) / n + F.lit(RANK_ERROR) if high else rank / n - F.lit(RANK_ERROR)
    at = (F.ceil(share * GRID) if high else F.floor(share * GRID)).cast("int")
    return F.when(at < GRID if high else at > 0, F.get("grid", at))


def _counted(known: DataFrame, brackets: DataFrame, group: list[str], ranks: range) -> DataFrame:
    """Values by how many brackets have begun (a) and ended (c) before them.

    Brackets come in the order of their ranks, so a value is inside those from
    c on to the one before a. Values inside none are one row per (a, c).
    """
    rows = attach(known, brackets, group, "inner")
    begun = sum([F.coalesce(F.col("__d") >= F.col(f"lo{r}"), F.lit(True)).cast("int") for r in ranks], F.lit(0))
    ended = sum([F.coalesce(F.col("__d") > F.col(f"hi{r}"), F.lit(False)).cast("int") for r in ranks], F.lit(0))
    rows = rows.select(*group, "__v", begun.alias("a"), ended.alias("c"))
    kept = F.when(F.col("a") > F.col("c"), F.col("__v")).alias("__v")
    return rows.groupBy(*group, "a", "c", kept).agg(F.count(F.lit(1)).alias("m"))


def _state(brackets: DataFrame, before: DataFrame, inside: DataFrame, by: list[str]) -> DataFrame:
    """For each bracket the values before it, the distinct and all values in
    it, and whether they hold its rank."""
    sizes = inside.groupBy(*by).agg(F.count(F.lit(1)).alias("inside"), F.sum("m").alias("all"))
    rows = join_null_safe(join_null_safe(brackets, before, by), sizes, by).fillna(0, ["before", "inside", "all"])
    return rows.withColumn("hit", (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("all")))


def _narrowed(known: DataFrame, left: DataFrame, group: list[str], by: list[str]) -> DataFrame:
    """Brackets (by, rank, lo, hi) of the ranks that are left: missed ones are
    open, crowded ones come from a sketch of their own values."""
    held = left.where("hit").select(*by, "lo", "hi")
    rows = attach(known, held, group, "inner").where("(lo IS NULL OR __d >= lo) AND (hi IS NULL OR __d <= hi)")
    sketched = rows.groupBy(*by).agg(F.kll_sketch_agg_double("__d", F.lit(SKETCH)).alias("sketch"), F.count(F.lit(1)).alias("k"))
    own = join_null_safe(left, sketched.select(*by, "k", _grid("sketch").alias("grid")), by)
    rank = F.col("rank") - F.col("before")
    # an end that stays open is the one that the bracket had
    low, high = (F.coalesce(_end(rank, F.col("k"), e == "hi"), F.col(e)) for e in ("lo", "hi"))
    return own.select(*by, "rank", F.when(F.col("hit"), low).alias("lo"), F.when(F.col("hit"), high).alias("hi"))


def quantile_columns(df: DataFrame, group: Sequence[str], value: str, named: dict[str, float]) -> DataFrame:
    """Exact quantiles as one row per group, one column per entry of ``named``."""
    long = exact_quantiles(df, group, value, sorted(set(named.values())))
    cols = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(n) for n, p in named.items()]
    return long.groupBy(*group).agg(*cols)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left", max_rows: int = BROADCAST_ROWS):
    """Join one-row-per-key ``stats`` on to a large table.

    ``stats`` is written once and counted. Up to ``max_rows`` rows Spark picks
    the join, as it knows the bytes that were written; beyond that both sides
    are shuffled with hot keys salted.
    """
    stats = materialise(stats)
    if stats.count() <= max_rows:
        return join_null_safe(df, stats, keys, how)
    return salted_join(df, stats, keys, how)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float | None = None) -> DataFrame:
    """Keys with more rows than an even partition has, and in how many parts
    (``__salts``) each must be cut so that none has more.

    ``share`` of all rows is one over the shuffle partitions by default; there
    are at most ``1/share`` such keys.
    """
    share = share or 1.0 / default_chunks(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    even = F.lit(share) * df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.where(F.col("__n") > even).select(*keys, F.ceil(F.col("__n") / even).cast("int").alias("__salts"))


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", salts: int | None = None, share: float | None = None
) -> DataFrame:
    """Join in which the rows of a hot left key are spread over several tasks,
    as many as they would fill (or ``salts``).

    Only hot keys are salted and only their right rows are copied. ``how`` is
    one of inner, left, left_semi and left_anti. Null keys match null keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do {how}")
    # at most 1/share rows, so the broadcasts below are bounded
    hot = hot_keys(left, keys, share)
    hot = materialise(hot if salts is None else hot.withColumn("__salts", F.lit(salts)))
    # salt from the row's own content, so a repeated task gives the same salt
    salt = F.pmod(F.xxhash64(*[F.col(c) for c, t in left.dtypes if not t.startswith("map")]), F.col("__salts"))
    big = join_null_safe(left, F.broadcast(hot), keys).withColumn("__salt", F.coalesce(salt, F.lit(0)).cast("int"))
    every = F.when(F.col("__salts").isNotNull(), F.sequence(F.lit(0), F.col("__salts") - 1)).otherwise(F.array(F.lit(0)))
    small = join_null_safe(right, F.broadcast(hot), keys).withColumn("__salt", F.explode(every))
    joined = join_null_safe(big.drop("__salts"), small.drop("__salts"), [*keys, "__salt"], how)
    return joined.drop("__salt")
