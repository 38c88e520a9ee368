"""Chunked scans, quantiles and joins against pandas, with a hot group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skylattice import ordered
from skylattice.operators import timeseries


def hot_series(n=600, seed=0):
    """One series with most rows, gaps and equal times."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "series": np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n)),
            "t": rng.integers(0, 150, n).astype("int64"),
            "v": np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n).round(3)),
        }
    )
    return pdf


@pytest.fixture(scope="module")
def pdf():
    return hot_series()


@pytest.fixture(scope="module")
def df(spark, pdf):
    raw = spark.createDataFrame(pdf)
    return raw.withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(5)


def by_id(frame, column):
    rows = frame.select("id", column).toPandas().sort_values("id")
    return rows[column].astype("float64").to_numpy()


def grouped(pdf):
    return pdf.sort_values(["t", "id"]).groupby("series")


def same(a, b):
    np.testing.assert_allclose(a, np.asarray(b, dtype="float64"), rtol=1e-9, equal_nan=True)


@pytest.mark.parametrize("chunks", [1, 2, 7, 50])
def test_row_number(df, pdf, chunks):
    got = ordered.OrderedRows(df, ["series"], ["t", "id"], chunks).row_number("r").finish()
    same(by_id(got, "r"), grouped(pdf).cumcount().sort_index() + 1)


@pytest.mark.parametrize("chunks", [2, 40])
@pytest.mark.parametrize("forward", [False, True])
def test_neighbour_row(df, pdf, chunks, forward):
    got = ordered.OrderedRows(df, ["series"], ["t", "id"], chunks).previous({"v": "p"}, forward).finish()
    same(by_id(got, "p"), grouped(pdf)["v"].shift(-1 if forward else 1).sort_index())


@pytest.mark.parametrize("chunks", [2, 40])
def test_nearest_known(df, pdf, chunks):
    known = F.col("v").isNotNull()
    rows = ordered.OrderedRows(df, ["series"], ["t", "id"], chunks)
    got = rows.nearest_known({"b": (F.col("v"), known, False), "a": (F.col("v"), known, True)}).finish().cache()
    same(by_id(got, "b"), grouped(pdf)["v"].ffill().sort_index())
    same(by_id(got, "a"), grouped(pdf)["v"].bfill().sort_index())


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, t long")
    got = {(r.k, r.t): r.r for r in ordered.OrderedRows(df, ["k"], ["t"], 3).row_number("r").finish().collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}


@pytest.mark.parametrize("block", [1, 16, 1000])
def test_bounded_frame(df, pdf, block):
    make = lambda w: F.sum("id").over(w.rowsBetween(-5, 0))
    got = ordered.bounded_frame(df, ["series"], ["t", "id"], 5, {"s": make}, 6, block)
    assert got.count() == len(pdf)
    want = grouped(pdf)["id"].rolling(6, min_periods=1).sum().reset_index(0, drop=True).sort_index()
    same(by_id(got, "s"), want)


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 500, p=[0.9, 0.1]), "v": rng.normal(size=500)})
    pdf.loc[rng.random(500) < 0.4, "v"] = 0.25
    got = ordered.exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", [0.0, 0.025, 0.5, 0.95, 1.0], 6).collect()
    assert len(got) == 10
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile(pdf.v[pdf.g == r["g"]], r["prob"]))


@pytest.mark.parametrize("most", [ordered.ORDERED_VALUES, 40])
def test_brackets_are_narrowed_and_missed_ones_opened(spark, monkeypatch, most):
    """Crowded brackets in rounds; sketches so poor that they miss ranks."""
    monkeypatch.setattr(ordered, "SKETCH", 8)
    monkeypatch.setattr(ordered, "RANK_ERROR", 0.01)
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.choice(["x", None], 6000, p=[0.95, 0.05]), "v": rng.normal(size=6000)})
    probs = [0.0, 0.01, 0.5, 0.51, 1.0]
    got = ordered.exact_quantiles(spark.createDataFrame(pdf, "g string, v double"), ["g"], "v", probs, most).collect()
    assert len(got) == 10
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile(pdf.v[pdf.g.isna() if r["g"] is None else pdf.g == r["g"]], r["prob"]))


def test_sketches_of_days_merge(spark):
    """Kept sketches of days serve for the quantiles of all days."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 5000), "day": rng.integers(0, 7, 5000), "v": rng.gamma(2, 3, 5000)})
    df = spark.createDataFrame(pdf)
    days = ordered.quantile_sketches(df, ["g", "day"], "v")
    merged = ordered.merged_sketches(days, ["g"])
    for r in merged.select("g", F.kll_sketch_get_n_double("sketch").alias("n"), F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("q")).collect():
        own = np.sort(pdf.v[pdf.g == r["g"]])
        assert r["n"] == len(own) and abs(np.searchsorted(own, r["q"]) / len(own) - 0.5) < ordered.RANK_ERROR
    got = ordered.exact_quantiles(df, ["g"], "v", [0.25, 0.9], sketches=merged).collect()
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile(pdf.v[pdf.g == r["g"]], r["prob"]))


def test_quantiles_leave_out_what_is_no_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), ("a", float("inf")), ("b", None)], "g string, v double")
    got = {(r["g"], r["prob"]): r["quantile"] for r in ordered.exact_quantiles(df, ["g"], "v", [0.0, 1.0]).collect()}
    assert got == {("a", 0.0): 1.0, ("a", 1.0): float("inf")}
    assert ordered.exact_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_quantile_of_one_and_of_equal_values(spark):
    df = spark.createDataFrame([("one", 4.0), ("same", 2.0), ("same", 2.0), ("none", None)], "g string, v double")
    got = {r["g"]: r["quantile"] for r in ordered.exact_quantiles(df, ["g"], "v", [0.3]).collect()}
    assert got == {"one": 4.0, "same": 2.0}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_plain_join(spark, how):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k")
    )
    right = spark.range(0, 400, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).unionByName(
        spark.createDataFrame([(7, -1), (7, -2)], "k long, v long")
    )
    got = ordered.salted_join(left, right, ["k"], how, salts=5)
    want = left.join(right, "k", how)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_salting_spreads_the_hot_key(spark):
    left = spark.range(1000).select("id", F.lit(1).alias("k"))
    hot = ordered.hot_keys(left, ["k"])
    assert [r.k for r in hot.collect()] == [1]
    with pytest.raises(ValueError):
        ordered.salted_join(left, left, ["k"], "full")


def test_keys_are_cut_by_what_a_partition_holds(spark):
    """Half of the rows, an eighth, and rare keys; a key of just under one in a hundred rows is cut too if partitions are many."""
    df = spark.range(16_000).select("id", F.when(F.col("id") % 2 == 0, -1).when(F.col("id") % 8 == 1, -2).otherwise(F.col("id")).alias("k"))
    assert {r.k: r["__salts"] for r in ordered.hot_keys(df, ["k"], 1 / 16).collect()} == {-1: 8, -2: 2}
    assert {r.k: r["__salts"] for r in ordered.hot_keys(df, ["k"], 1 / 200).collect()} == {-1: 100, -2: 25}
    joined = ordered.salted_join(df, spark.createDataFrame([(-1, "a"), (-2, "b"), (3, "c")], "k long, v string"), ["k"], share=1 / 200)
    assert {r.v: r["count"] for r in joined.groupBy("v").count().collect()} == {"a": 8000, "b": 2000, "c": 1}


def test_attach_beyond_the_broadcast_bound(spark):
    df = spark.range(200).select("id", (F.col("id") % 10).alias("k"))
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for bound in (0, 100):
        got = ordered.attach(df, stats, ["k"], max_rows=bound)
        assert got.count() == 200 and got.where("n <> 20").count() == 0


# --- operators built on the scans ---------------------------------------


def test_interpolation_is_per_series(df, pdf):
    got = timeseries.interpolate(df, ["series"], ["t", "id"], "v")
    want = grouped(pdf)["v"].apply(lambda s: s.interpolate("linear")).reset_index(0, drop=True).sort_index()
    same(by_id(got, "filled"), want)


def test_fill_forward_limit(df, pdf):
    got = timeseries.fill_forward(df, ["series"], ["t", "id"], ["v"], 2)
    same(by_id(got, "v"), grouped(pdf)["v"].ffill(limit=2).sort_index())


def test_rolling_std_waits_until_full(df, pdf):
    full = df.withColumn("w", F.col("id") * 1.5)
    got = timeseries.rolling_std(full, ["series"], ["t", "id"], "w", 10)
    want = (pdf.assign(w=pdf.id * 1.5)).sort_values(["t", "id"]).groupby("series")["w"].rolling(10).std()
    same(by_id(got, "rolling_std"), want.reset_index(0, drop=True).sort_index())


def test_percent_change_fills_first(df, pdf):
    got = timeseries.shift_return(df, ["series"], ["t", "id"], "v", fill_first=True)
    filled = grouped(pdf)["v"].ffill()
    before = filled.reindex(pdf.sort_values(["t", "id"]).index).groupby(pdf["series"]).shift(1)
    want = (filled / before - 1).sort_index().to_numpy()
    mine = by_id(got, "change")
    ok = np.isfinite(want)
    np.testing.assert_allclose(mine[ok], want[ok], rtol=1e-9)


def test_regular_axis_in_pieces(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01 00:00:00", 1.0), ("a", "2020-01-02 00:00:00", 2.0), ("b", "2020-01-01 05:00:00", 3.0)],
        "k string, t string, v double",
    ).withColumn("t", F.col("t").cast("timestamp"))
    got = timeseries.as_frequency(df, ["k"], "t", 3600, ["v"], steps_per_row=7)
    rows = got.orderBy("k", "t").collect()
    assert len(rows) == 26
    assert [r.v for r in rows if r.v is not None] == [1.0, 2.0, 3.0]
    assert len({(r.k, r.t) for r in rows}) == 26


def test_business_days(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-14')) AS d")
    got = {str(r.d): str(r.b) for r in days.select("d", timeseries.business_day(F.col("d")).alias("b")).collect()}
    assert got["2024-01-05"] == got["2024-01-06"] == got["2024-01-07"] == "2024-01-05"
    assert got["2024-01-08"] == "2024-01-08"


def test_outer_merge_is_the_full_join(spark):
    from skylattice.operators import joins

    left = spark.createDataFrame([(i % 5, i) for i in range(50)] + [(99, -1)], "k long, a long")
    right = spark.createDataFrame([(0, 7), (0, 8), (3, 9), (77, 10)], "k long, b long")
    got = joins.join_outer_common(left, right).select("k", "a", "b").collect()
    want = left.join(right, "k", "full").select("k", "a", "b").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


# --- scans over sorted partitions ----------------------------------------


def part_sizes(df, group, order, n):
    rows, at = ordered.OrderedRows(df, group, order, n).parts()
    sizes = rows.groupBy(F.shiftright(at, 33)).count().collect()
    assert sum(r["count"] for r in sizes) == df.count()
    return [r["count"] for r in sizes]


@pytest.mark.parametrize(
    "key",
    [
        "id % 3",
        "if(id % 2 = 0, id, null)",
        "concat('https://example.org/one/prefix/', id)",
        "1",
    ],
    ids=["three values", "half null", "one prefix", "one value"],
)
def test_partitions_are_even(spark, key):
    """Ties, nulls and equal string starts do not make a large partition."""
    df = spark.range(100_000, numPartitions=4).select("id", F.expr(key).alias("k"))
    for group, order in (([], ["k"]), (["k"], ["k"])):
        sizes = part_sizes(df, group, order, 16)
        assert len(sizes) == 16 and max(sizes) < 2 * 100_000 / 16


def test_small_groups_make_no_summaries(spark, monkeypatch):
    """1,500 groups over 8 partitions: 8 rows are carried."""
    written = []
    plain = ordered.materialise
    monkeypatch.setattr(ordered, "materialise", lambda d: written.append(plain(d)) or written[-1])
    df = spark.range(6000).select("id", (F.col("id") % 1500).alias("k"))
    got = ordered.OrderedRows(df, ["k"], ["id"], 8).row_number("n").previous({"id": "before"}).finish()
    assert got.where("n <> floor(id / 1500) + 1 OR coalesce(before, id - 1500) <> id - 1500").count() == 0
    assert [t.count() for t in written] == [6000, 8]


def plain_scan(rows):
    """Everything a scan offers, by going through each group; rows are (group, time, id, value)."""
    nan = lambda x: "nan" if x is not None and x != x else x
    out = {}
    groups = {}
    for r in rows:
        groups.setdefault(nan(r[0]), []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, r in enumerate(members):
            back = [(m[3], j + 1) for j, m in enumerate(members[: i + 1]) if m[3] is not None]
            strict = [x for x in back if x[1] <= i]
            ahead = [(m[3], j + 1) for j, m in enumerate(members) if j >= i and m[3] is not None]
            none = (None, None)
            before = members[i - 1][3] if i else None
            after = members[i + 1][3] if i + 1 < len(members) else None
            out[r[2]] = (i + 1, before, after, *(back[-1] if back else none), strict[-1][0] if strict else None, *(ahead[0] if ahead else none))
    return out


@pytest.mark.parametrize("kind", ["double", "string"])
@pytest.mark.parametrize("parts", [1, 3, 17])
def test_all_scans_at_once(spark, kind, parts):
    """A hot group of few known values, null and NaN groups, null times, ties, single rows."""
    rng = np.random.default_rng(parts)
    names = {"double": [1.5, -0.5, None, float("nan")], "string": ["hot", "b", None, ""]}[kind]
    rows = []
    for i in range(400):
        group = names[0] if rng.random() < 0.6 else names[rng.integers(1, 4)]
        time = None if rng.random() < 0.1 else int(rng.integers(0, 40))
        rows.append((group, time, i, None if rng.random() < (0.99 if group == names[0] else 0.5) else f"v{i}"))
    if kind == "double":
        rows += [(float(100 + i), 0, 400 + i, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(rows, f"g {kind}, t long, id long, v string").repartition(4)
    value, known = F.col("v"), F.col("v").isNotNull()
    scan = ordered.OrderedRows(df, ["g"], ["t", "id"], parts).row_number("n").previous({"v": "before"}).previous({"v": "after"}, True)
    scan = scan.nearest_known({"back": (value, known, False), "ahead": (value, known, True)}, {"back": "back_at", "ahead": "ahead_at"})
    got = scan.nearest_known({"strict": (value, known, False)}, strict=True).finish().collect()
    wanted = plain_scan(rows)
    names = ("n", "before", "after", "back", "back_at", "strict", "ahead", "ahead_at")
    assert {r["id"]: tuple(r[c] for c in names) for r in got} == wanted


def test_scan_of_nothing_and_of_clashing_names(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b")], "`__at` long, `__pos` long, `__part` string")
    got = ordered.OrderedRows(df, ["__at"], ["__pos"], 2).row_number("n").previous({"__part": "p"}).finish()
    assert sorted(map(tuple, got.select("__at", "__pos", "__part", "n", "p").collect())) == [(1, 2, "a", 1, None), (1, 3, "b", 2, "a")]
    assert ordered.OrderedRows(df.limit(0), ["__at"], ["__pos"], 2).row_number("n").previous({"__part": "p"}).finish().count() == 0
