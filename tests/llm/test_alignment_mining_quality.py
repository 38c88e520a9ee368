"""Token alignment, hard negatives and the quality classifier against plain versions, and on awkward tables."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skylattice.llm import hard_negatives, quality_classifier, queries, token_alignment
from tests.llm import fixtures

FOLDER = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["a▁b", "\0", "<s> <0x0A> <|endoftext|> </s>", "ﬁ İ Σ́ \x85\xa0", "  two  blanks ", "中文字", "\U0001f600\U0001f600", "x" * 700]


def spelled(text, library, model, byte_of):
    """Identifiers and bytes of the tokens, as the libraries give them."""
    a = library.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(byte_of[c] for c in library.id_to_token(i)) for i in a]
    b = model.encode(text)
    b_bytes = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a, a_bytes, b, b_bytes) if b"".join(a_bytes) == b"".join(b_bytes) == whole else ([], [], [], [])


def plain_alignment(texts):
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}
    rows, counts = [], Counter()
    for text in texts:
        a, a_bytes, b, b_bytes = spelled(text, library, model, byte_of) if text else ([], [], [], [])
        ends = [[*itertools.accumulate(map(len, x))] for x in (a_bytes, b_bytes)]
        links = [(i, j) for e, i in zip(ends[0], a) for f, j in zip(ends[1], b) if e == f] if len(a) < 400 else [
            (i, j) for e, i in zip(ends[0], a) if e in set(ends[1]) for j in [b[ends[1].index(e)]]
        ]
        counts.update(links)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        group = lambda k: [sum(c < e for c in cuts) for e in ends[k]]
        sides = [group(0), group(1)]
        written = ";".join("|".join(",".join(str(x) for x, g in zip(ids, side) if g == k) for ids, side in zip((a, b), sides)) for k in range(len(cuts)))
        shared = sum(sides[0].count(k) * sides[1].count(k) for k in range(len(cuts)))
        starts = [[0, *e[:-1]] for e in ends]
        overlaps = sum(max(s, t) < min(e, f) for s, e in zip(starts[0], ends[0]) for t, f in zip(starts[1], ends[1])) if len(a) < 400 else None
        rows.append((len(a), len(b), len(cuts), links, hashlib.sha256(written.encode()).hexdigest() if a else "", overlaps, shared))
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (n_a, n_b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha, over, shared)
        for n_a, n_b, g, links, sha, over, shared in rows
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_shared")


def test_alignment_query(spark, tmp_path):
    texts = [r["text"][:1500] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    texts += [*ODD, None, "", "", "same", "same"]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op11_token_alignment(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, row in enumerate(plain_alignment(texts)):
        for name, value in zip(COLUMNS, row):
            assert value is None or got[i][name] == value, (texts[i], name)


def test_alignment_links(spark):
    """Overlap links with their bytes, and shared-group links, by looking at all pairs."""
    texts = ["international understanding", "a▁b", "\U0001f600 x", None]
    tool = token_alignment.aligner(A, B)
    found = token_alignment.align(spark.createDataFrame([*enumerate(texts)], "k int, text string"), A, B, links=True).collect()
    for text, r in zip(texts, (x["alignment"] for x in sorted(found, key=lambda x: x["k"]))):
        a, b = tool.tokens(text)
        spans = []
        for ids, vocabulary in ((a, tool.a), (b, tool.b)):
            ends = [*itertools.accumulate(len(vocabulary.bytes[i]) for i in ids)]
            spans.append([*zip([0, *ends], ends)])
        meet = lambda s, t: min(s[1], t[1]) - max(s[0], t[0])
        assert [tuple(x) for x in r["overlaps"]] == [(i, j, meet(s, t)) for i, s in enumerate(spans[0]) for j, t in enumerate(spans[1]) if meet(s, t) > 0]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        group = lambda s: sum(c < s[1] for c in cuts)
        assert [tuple(x) for x in r["shares"]] == [(i, j) for i, s in enumerate(spans[0]) for j, t in enumerate(spans[1]) if group(s) == group(t)]


def test_row_products(monkeypatch):
    monkeypatch.setattr(token_alignment, "EXPANDED", 7)
    rng = np.random.default_rng(0)
    for _ in range(50):
        n, m, k = rng.integers(1, 9, 3)
        x, y = (rng.integers(0, 3, s) * (rng.random(s) < 0.5) for s in ((n, m), (m, k)))

        def rows_of(dense):
            at, columns = np.nonzero(dense)
            return token_alignment.Rows(token_alignment.counted(np.bincount(at, minlength=len(dense))), columns, dense[at, columns], dense.shape[1])

        out = np.zeros((n, k), dtype=int)
        i, j, v = token_alignment.gathered(rows_of(x).times(rows_of(y)))
        out[i, j] = v
        assert (out == x @ y).all() and len(set(zip(i, j))) == len(i)
        back = rows_of(x).transposed().times(rows_of(np.eye(n, dtype=int)))
        turned = np.zeros((m, n), dtype=int)
        i, j, v = token_alignment.gathered(back)
        turned[i, j] = v
        assert (turned == x.T).all()


def test_alignment_of_awkward_rows(spark):
    got = token_alignment.link_statistics(fixtures.frame(spark), A, B).collect()
    assert len(got) == len(fixtures.rows()) and all(r["row"] == "clash" and r["n_tokens"] == "clash" for r in got)
    by = {r["doc_id"]: r for r in got}
    for i in (6, 7):
        assert [by[i][c] for c in COLUMNS] == [0, 0, 0, 0, 0, 0, "", 0, 0]
    assert by[9]["n_a"] == 0 and by[12]["n_a"] > 0 and by[8]["n_a"] > 0
    twins = [tuple(r) for r in got if r["doc_id"] == 10]
    assert len(twins) == 3 and len(set(twins)) == 2
    assert token_alignment.link_statistics(fixtures.empty(spark), A, B).count() == 0


def embeddings(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(420):
        kind = rng.random()
        vector = [rng.gauss(0.1, 0.3) for _ in range(24)]
        label = rng.choice([0, 0, 0, 1, 2, 9])
        if kind < 0.05:
            label = None
        elif kind < 0.1:
            vector = rng.choice([None, [], [0.0], [1.0, None], [math.nan, 1.0], [math.inf], [0.5, 0.5]])
        elif kind < 0.2 and rows:
            vector = rows[rng.randrange(len(rows))][1]
        rows.append((i if rng.random() < 0.97 else rng.choice([None, 100]), vector, label))
    return [*rows, *rows[100:130], (200, [0.2] * 24, 7), (300, [-0.1] * 3, 5)]


def plain_negatives(rows):
    known = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, [math.floor(256 * x) for x in map(float, map(np.float32, vector))]))
    out = []
    for k, (anchor, label, vector) in enumerate(known):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i is None, i or 0, n, i, l) for n, (i, l, v) in enumerate(known) if n != k]
        scored.sort()
        for s, _, _, _, positive, _ in [x for x in scored if x[5] == label][:5]:
            fit = [x for x in scored if x[5] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(anchor, positive, rank, x[4], -s, -x[0]) for rank, x in enumerate(fit, 1)]
    return out


@pytest.mark.parametrize("block", [hard_negatives.BLOCK, 700])
def test_hard_negatives_query(spark, tmp_path, monkeypatch, block):
    """Nulls, infinite and ragged vectors, repeated rows and clashing names among them."""
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = embeddings(4)
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, row string, cell string")
    table.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_hard_negatives(spark, str(tmp_path)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    expected = plain_negatives(rows)
    assert len(expected) > 60
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_no_vectors(spark, tmp_path):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    empty.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op12_hard_negatives(spark, str(tmp_path)).count() == 0


def test_windows_fill_exactly():
    rng = np.random.default_rng(0)
    for trial in range(40):
        d, n, m = int(rng.integers(1, 70)), int(rng.integers(1, 300)), int(rng.integers(1, 20))
        rows = rng.normal(0, 60, (n, d)).astype(int)
        rows[rng.random(n) < 0.1] = 0
        if trial % 3 == 0:
            rows[rng.random((n, d)) < 0.8] = 0
        asked, label, first = rows[rng.integers(0, n, m)], rng.integers(0, 3, n), rng.permutation(n)
        scores = asked @ rows.T
        windows = [[(-np.inf, np.inf)] if trial % 2 else [(-(-4 * s // 5), s) for s in sorted(rng.choice(scores[i], 3))[::-1] if s >= 0] for i in range(m)]
        got = {(i, k): [*r] for i, k, r, _ in hard_negatives.best_in_windows(asked, rows, lambda i, j: label[j] != i % 3, first, windows, 5)}
        for i, k in ((i, k) for i in range(m) for k in range(len(windows[i]))):
            low, high = windows[i][k]
            fit = [j for j in range(n) if label[j] != i % 3 and low <= scores[i, j] <= high]
            assert got[i, k] == sorted(fit, key=lambda j: (-scores[i, j], first[j]))[:5]


def test_index_leaves_out_what_the_bound_covers():
    """Short rows are not listed, and the tails of long ones only at low thresholds."""
    rng = np.random.default_rng(1)
    rows = (rng.normal(0, 100, (200, 64)) * 0.9 ** np.arange(64)).astype(int)
    rows[:50] //= 20
    index = hard_negatives.Index(rows)
    listed = []
    for share in hard_negatives.LEVELS[:4]:
        index.lower(share * index.longest)
        listed.append([len(r) for r, _ in index.lists])
        least = np.full(5, share * index.longest) * np.sqrt(np.square(rows[60:65]).sum(axis=1))
        i, j = index.candidates(rows[60:65], least)
        assert {*zip(*np.nonzero(rows[60:65] @ rows.T >= least[:, None]))} <= {*zip(i, j)}
    assert listed[0][0] <= 150 and listed[0][-1] == 0 and all(sum(a) <= sum(b) for a, b in zip(listed, listed[1:]))


def test_quality_held_out(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op13_quality_classifier(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) >= 0.9


def test_flat_trees_give_what_walking_gives():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 5)).round(1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    trees = quality_classifier.fit_trees(x, y, trees=12, depth=3)
    got = trees.scores(x)

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + math.exp(-total))

    assert got == pytest.approx([walk(r) for r in x]) and np.mean((got > 0.5) == y) > 0.97


def test_first_split_is_the_best_of_all():
    """One tree of depth one against every split of every column."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 40, (300, 4)).astype(float)
    y = (x[:, 2] + rng.normal(0, 8, 300) > 22).astype(float)
    tree = quality_classifier.fit_trees(x, y, trees=1, depth=1)
    p = 1 / (1 + math.exp(-tree.start))
    g, h = p - y, np.full(300, p * (1 - p))

    def gain(low):
        if min(h[low].sum(), h[~low].sum()) < quality_classifier.LEAST_WEIGHT:
            return 0
        return sum(g[s].sum() ** 2 / (h[s].sum() + quality_classifier.RIDGE) for s in (low, ~low))

    best = max(gain(x[:, f] <= v) for f in range(4) for v in np.unique(x[:, f])[:-1])
    root = tree.roots[0]
    assert gain(x[:, tree.feature[root]] <= tree.limit[root]) == pytest.approx(best)


def test_quality_of_awkward_rows(spark):
    frame = fixtures.frame(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (2, 1, "x"), (3, None, "x"), (None, 1, "x"), (10, 5, "x"), (99, 1, "x"), (12, 0, "x"), (12, 0, "x")], "doc_id long, quality int, text string")
    trees = quality_classifier.fit(labels, frame)
    got = quality_classifier.score(frame, trees).collect()
    assert len(got) == len(fixtures.rows()) and all(0 <= r["score"] <= 1 and r["row"] == "clash" for r in got)
    assert quality_classifier.sample(labels, frame, "doc_id", "text", "quality", 100).count() == 4
    none = quality_classifier.fit(labels.where(F.lit(False)), frame)
    assert {r["score"] for r in quality_classifier.score(frame, none).collect()} == {0.5}
    assert quality_classifier.score(fixtures.empty(spark), trees).count() == 0
    assert len(quality_classifier.NAMES) == len(quality_classifier.statistics(None)) == len(quality_classifier.statistics("a b.\n"))
