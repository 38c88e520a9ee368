"""Operators keep rows with nulls and with labels that nobody listed."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from skylattice.operators import aggregates, features, grid, joins, models, neighbours, reshape, verification


def test_pivots_keep_keys_without_a_listed_label(spark):
    df = spark.createDataFrame([(1, "A", 2.0), (1, "A", 4.0), (2, "Z", 1.0)], "k int, c string, v double")
    assert sorted(map(tuple, reshape.pivot_mean(df, ["k"], "c", ["A"], "v").collect())) == [(1, 3.0), (2, None)]
    assert sorted(map(tuple, reshape.pivot_count(df, ["k"], "c", ["A"]).collect())) == [(1, 2), (2, None)]


def test_groups_without_a_listed_member_stay(spark):
    df = spark.createDataFrame([(1, "A", 2.0), (2, "Z", 1.0)], "k int, c string, v double")
    got = {r["k"]: r["v"] for r in aggregates.collect_members(df, ["k"], "c", ["A", "B"], ["v"]).collect()}
    assert got == {1: [2.0, None], 2: [None, None]}


def test_assemble_never_drops_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        features.assemble(df, ["a", "b"]).collect()


@pytest.mark.parametrize("kind, values", [("string", ["b", None, "a"]), ("int", [7, None, 3])])
def test_null_label_has_a_null_code(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    got = {r["v"]: r["code"] for r in features.label_encode(df, "v", "code").collect()}
    first, _, last = values
    assert got == {last: 0, first: 1, None: None}


def test_a_null_is_no_event_in_every_table(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 1), (None, None), (0, 0)], "o int, f int")
    o, f = F.col("o") == 1, F.col("f") == 1
    counts = {"tp": 1, "fp": 1, "fn": 1, "tn": 2}
    assert verification.contingency(df, o, f).first().asDict() == counts
    row = verification.score_table(df, o, {"a": f}).first().asDict()
    assert {k: row[k] for k in counts} == counts and (row["precision_1"], row["f1_0"]) == (0.5, 2 / 3)
    names = {"truePositive": "tp", "falsePositive": "fp", "falseNegative": "fn", "trueNegative": "tn"}
    got = verification.with_category(df, "o", "f").groupBy("result_category").count().collect()
    assert {names[r["result_category"]]: r["count"] for r in got} == counts


def test_rows_are_numbered_along_text(spark):
    texts = ["", "b", "a", "abcdefgh", "abcdefga", "é", "z", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["row_index"] for r in reshape.with_row_index(df, ["t"]).collect()}
    known = sorted((t for t in texts if t is not None), key=str.encode)
    assert got == {t: i for i, t in enumerate([None, *known])}


def test_one_hot_gives_nulls_a_place(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    got = {r["v"]: r["hot"].toArray().tolist() for r in features.one_hot_inferred(df, "v", "hot").collect()}
    assert got == {"a": [1, 0, 0], "b": [0, 1, 0], None: [0, 0, 1]}


def test_alignment_keeps_keys_of_either_side(spark):
    a, b = (spark.createDataFrame(rows, "k int, v long") for rows in ([(1, 2), (None, 3)], [(1, 5), (2, 7)]))
    got = {r["k"]: (r["a"], r["b"], r["total"]) for r in joins.align_add(a, b, ["k"], "v").collect()}
    assert got == {1: (2, 5, 7), 2: (None, 7, None), None: (3, None, None)}


def test_sites_outside_the_grid_stay(spark):
    cells = spark.createDataFrame([(y, x, float(10 * y + x)) for y in (0, 1) for x in (0, 1)], "y int, x int, v double")
    sites = spark.createDataFrame([(1, 0.5, 0.25), (2, 1.0, 1.0), (3, 0.5, 1.5), (4, None, 0.0)], "id int, py double, px double")
    got = grid.interpolate_sites(sites, cells, {"py": ("y", 0.0, 1.0), "px": ("x", 0.0, 1.0)}, "v")
    assert {r["id"]: r["interpolated"] for r in got.collect()} == {1: 5.25, 2: 11.0, 3: None, 4: None}


def test_scores_give_labels(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, f array<double>")
    got = models.score_batches(df, "f", np.eye(2), np.zeros(2), ["id"], [5, 9]).collect()
    assert {r["id"]: r["prediction"] for r in got} == {1: 5, 2: 9}


def test_class_of_one_row_is_an_error(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [2.0], 1)], "id long, features array<double>, label int")
    with pytest.raises(ValueError, match="one row"):
        neighbours.smote(df, "label", 1, 0)
