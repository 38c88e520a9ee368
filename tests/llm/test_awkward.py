"""Every operator and stage on awkward tables, and on empty ones."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skylattice.llm import chat_format, decontamination, kneser_ney, language_id, line_dedup, quality_rules, sentencepiece_dropout, sharding, simhash_dedup, token_counts
from tests.llm import fixtures

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_line_dedup(spark):
    got = line_dedup.remove_boilerplate(fixtures.frame(spark)).collect()
    assert len(got) == len(fixtures.rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (None, 10)}
    assert fixtures.LINE in by[1]["text"] and by[1]["n_removed"] == 0
    assert by[3]["text"] == "\nthird" and by[3]["n_removed"] == 2
    assert by[4]["text"] == "" and by[6]["text"] is None and by[5]["text"] == "x"
    assert all(r["key"] == "clash" and r["gone"] == "clash" for r in got)
    assert line_dedup.remove_boilerplate(fixtures.empty(spark)).count() == 0


def test_line_dedup_counts_near_the_threshold_exactly(spark):
    """Lines on four, five and many sites; a null site is none."""
    rows = [(n * 1000 + s, f"line that stands on {n} sites", f"s{s}") for n in (4, 5, 6, 300) for s in range(n)]
    rows += [(9, "line that stands on 4 sites", None)]
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("n_removed > 0").collect()
    assert sorted(r["doc_id"] for r in got) == [n * 1000 + s for n in (5, 6, 300) for s in range(1, n)]


@pytest.mark.parametrize("broadcast_shingles", [0, decontamination.BROADCAST_SHINGLES])
def test_decontamination(spark, monkeypatch, broadcast_shingles):
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", broadcast_shingles)
    item = "zero one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, item)], "item_id long, text string")
    docs = fixtures.frame(spark, fixtures.rows() + [(20, f"before it all, {item.upper()}. and after", "en", "a", 1, *["clash"] * fixtures.EXTRA), (None, item, None, None, None, *["clash"] * fixtures.EXTRA)])
    found = decontamination.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0, r["similarity"], r["start"]) for r in found) == [(0, 0, 1.0, 0), (0, 1, 1.0, 0), (20, 0, 1.0, 3), (20, 1, 1.0, 3)]
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(fixtures.rows())
    assert decontamination.decontaminate(fixtures.empty(spark), bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_near_duplicates(spark):
    got = simhash_dedup.near_duplicates(fixtures.frame(spark)).collect()
    assert len(got) == len(fixtures.rows())
    assert {r["component_id"] for r in got if r["doc_id"] in (6, 7, 8)} == {6}
    kept = simhash_dedup.keep_one(fixtures.frame(spark))
    assert kept.columns == fixtures.frame(spark).columns
    ids = sorted(r["doc_id"] or 0 for r in kept.collect())
    assert ids.count(10) == 2 and ids.count(0) == 1 and 6 in ids and 7 not in ids
    assert simhash_dedup.keep_one(fixtures.empty(spark)).count() == 0


def test_quality(spark):
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(fixtures.frame(spark)).collect()}
    assert len(got) == len({r[0] for r in fixtures.rows()})
    assert got[6]["n_words"] == 0 and got[6]["base_failed"] and not got[6]["kept"] and not got[7]["kept"]
    assert got[9]["n_repeat_words"] == 30_000 and got[9]["base_failed"]
    assert got[12]["word_chars"] == 50_000 and got[None]["kept"]
    assert quality_rules.apply_rules(fixtures.empty(spark)).count() == 0


def test_shards(spark):
    order = [F.col("doc_id"), F.xxhash64("text")]
    got = sharding.shard_rows(fixtures.frame(spark), order, 4, seed=3).collect()
    places = sorted((r["shard"], r["slot"]) for r in got)
    n = len(fixtures.rows())
    assert places == sorted((p % 4, p // 4) for p in range(n))
    assert sharding.shard_rows(fixtures.empty(spark), order, 4).count() == 0


def test_sentencepiece(spark):
    got = sentencepiece_dropout.encode_checked(fixtures.frame(spark), PIECES, F.col("doc_id")).collect()
    assert all(r["lossless"] for r in got if r["text"] is not None)
    null = next(r for r in got if r["doc_id"] == 6)
    assert null["ids"] is None and null["lossless"] is None and null["n_pieces"] is None
    assert next(r for r in got if r["doc_id"] == 7)["ids"] == []
    there = sentencepiece_dropout.decode(sentencepiece_dropout.encode(fixtures.frame(spark), PIECES, F.col("doc_id"), out="pieces"), PIECES, "pieces")
    assert there.where(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0
    assert sentencepiece_dropout.encode_checked(fixtures.empty(spark), PIECES, F.col("doc_id")).count() == 0


def test_token_counts(spark):
    got = {r["doc_id"]: r for r in token_counts.count_tokens(fixtures.frame(spark), WORDS).collect()}
    assert got[6]["n_tokens"] == got[7]["n_tokens"] == got[8]["n_tokens"] == 0 and got[9]["n_tokens"] > 30_000
    assert token_counts.count_tokens(fixtures.empty(spark), WORDS).count() == 0


def test_language(spark):
    network = language_id.fit(fixtures.frame(spark), steps=20)
    assert network.languages == ["de", "en"]
    got = {r["doc_id"]: r for r in language_id.predict(fixtures.frame(spark), network).collect()}
    assert [got[i]["lang_pred"] for i in (6, 7, 8, 11)] == ["und"] * 4 and got[6]["score"] == 0
    assert got[9]["lang_pred"] in ("de", "en") and 0 <= got[9]["score"] <= 1
    nothing = language_id.fit(fixtures.empty(spark))
    assert language_id.predict(fixtures.frame(spark), nothing).where("lang_pred <> 'und'").count() == 0


def test_scores(spark):
    model = kneser_ney.train(fixtures.frame(spark), bits=3)
    got = {r["doc_id"]: r for r in kneser_ney.score(fixtures.frame(spark), model).collect()}
    assert got[6]["n_tokens"] == 1 and got[6]["score"] == got[7]["score"] == got[8]["score"] < 0
    assert got[9]["n_tokens"] > 30_000 and all(r["train_tokens"] == model.n_tokens for r in got.values())
    nothing = kneser_ney.train(fixtures.empty(spark), bits=3)
    assert {r["score"] for r in kneser_ney.score(fixtures.frame(spark), nothing).collect()} == {0.0}
    assert kneser_ney.score(fixtures.empty(spark), model).count() == 0


def test_chats(spark):
    rows = [(None, 0, "user", "a"), (None, 1, None, "b"), (1, None, "assistant", None), (1, 1, "user", "<|end|>"), (1, 1, "user", "<|end|>"), (2, 0, "robot", "")]
    chats = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "conv_id long, turn long, role string, text string, c string, t string, at string")
    for segment in (10_000, 1):
        got = sorted(chat_format.format_chats(chats, segment=segment).collect(), key=lambda r: (r["conv_id"] or 0, r["segment"]))
        whole = {}
        for r in got:
            whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["rendered"]
        assert whole[None] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
        assert whole[1] == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n<|user|>\n< |end|>\n< |end|><|end|>\n<|assistant|>\n<|end|>\n"
        assert sum(r["n_messages"] for r in got) == 6
    assert chat_format.format_chats(chats.limit(0)).count() == 0


@pytest.mark.parametrize("which", range(len(corpus_pipeline.STAGES)))
def test_stage(spark, which):
    _, stage = corpus_pipeline.STAGES[which]
    folder = "/root/testdata/sf0.001"
    docs = fixtures.frame(spark)
    out = stage(spark, docs, folder)
    if which < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns
    assert out.count() <= docs.count()
    assert stage(spark, fixtures.empty(spark), folder).count() == 0
