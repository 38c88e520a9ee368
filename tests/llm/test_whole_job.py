"""Cases that operators once cut short."""

import random

import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from skylattice.llm import decontamination, queries, sentencepiece_dropout

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"


def rows_of(texts):
    return [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]


def test_a_word_has_several_segmentations(spark, tmp_path):
    """Through op4's query and the last stage, equal texts of many documents."""
    frame = spark.createDataFrame(rows_of(["international understanding of meteorological observations"] * 60), SCHEMA)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    stored = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for done in (queries.op4_sentencepiece(spark, str(tmp_path)), corpus_pipeline.encoded(spark, stored, FOLDER)):
        got = done.collect()
        assert all(r["lossless"] for r in got)
        assert len({tuple(r["ids"]) for r in got}) > 1


@pytest.mark.parametrize("broadcast_shingles", [0, decontamination.BROADCAST_SHINGLES])
def test_items_with_a_repeated_word_for_a_tail_are_found(spark, monkeypatch, broadcast_shingles):
    """Similarity 41/51, fingerprints often far apart."""
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", broadcast_shingles)
    rng = random.Random(6)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(50)] for _ in range(40)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame(rows_of([" ".join(["before", *w[:45], *["same"] * 5]) for w in items]), SCHEMA)
    got = sorted((r["doc_id"], r["item_id"], r["similarity"], r["start"]) for r in decontamination.contaminated(docs, bench).collect())
    assert got == [(i, i, 41 / 51, 1) for i in range(40)]


def test_short_lines_on_many_sites_are_boilerplate_in_the_pipeline(spark):
    sites = [(i, f"own words of text {i}\nAll rights reserved.\n\nHome", "en", f"s{i}", 9) for i in range(5)]
    few = [(9, "Seen here only", "en", "s0", 9), (10, "Seen here only", "en", "s1", 9)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_boilerplate(spark, spark.createDataFrame(sites + few, SCHEMA), FOLDER).collect()}
    assert got[0] == sites[0][1] and got[9] == got[10] == "Seen here only"
    assert all(got[i] == f"own words of text {i}\n" for i in range(1, 5))


def rescan(chunk, pieces, key, dropout):
    """Merges by looking at all pairs again after each one; a skipped pair stays apart until a neighbour changes."""
    symbols, out = [*chunk], set()
    while True:
        found = []
        for i, (a, b) in enumerate(zip(symbols, symbols[1:])):
            if a + b in pieces.ranks and xxhash.xxh64_intdigest(f"{key}\0{a}\0{b}".encode()) >= int(dropout * 2**64):
                found.append((pieces.ranks[a + b], i))
        if not found:
            return symbols
        _, i = min(found)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_dropout_by_rescanning_all_pairs(spark, tmp_path):
    """op4's query against a plain rescan with the same keyed skips."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [r["text"][:400] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += ["", "a▁b", "x" * 90, "\0\n\t", "中文 mixed ü"]
    spark.createDataFrame(rows_of(texts), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    variants = {r["doc_id"]: r["v"] for r in spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("doc_id", f"pmod(xxhash64(doc_id, 0), {sentencepiece_dropout.VARIANTS}) AS v").collect()}
    pieces = sentencepiece_dropout.Pieces(path)
    literal = [pieces.byte_ids[b] for b in "▁".encode()]
    for r in queries.op4_sentencepiece(spark, str(tmp_path)).collect():
        text, wanted = texts[r["doc_id"]], []
        for k, part in enumerate(f" {text}".split("▁") if text else []):
            wanted += literal if k else []
            for s in rescan(part.replace(" ", "▁"), pieces, f"0/{variants[r['doc_id']]}", 0.1):
                wanted += [pieces.ids[s]] if s in pieces.ids else [pieces.byte_ids[b] for b in s.encode()]
        assert r["ids"] == wanted and r["n_pieces"] == len(wanted) and r["lossless"], text


def test_generations_of_the_cache_change_nothing():
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces, rng = sentencepiece_dropout.Pieces(path), random.Random(3)
    small, large = (sentencepiece_dropout.Encoder(pieces, "0/1", 0.1, kept) for kept in (3, 1000))
    chunks = ["".join(rng.choice("abcde▁") for _ in range(rng.randint(1, 80))) for _ in range(40)]
    for _ in range(300):
        chunk = rng.choice(chunks)
        assert small[chunk] == large[chunk]
        assert len(small) <= 3 and len(small.older) <= 3
    assert all(len(c) <= sentencepiece_dropout.SHORT for c in large)
