"""Queries and operators against plain versions on small tables."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skylattice.llm import chat_format, kneser_ney, language_id, queries, sentencepiece_dropout, sharding, simhash_dedup, token_counts
from skylattice.llm.common import cut
from tests.compare import differences

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def lowered(text):
    return text.encode().lower().decode()


@pytest.mark.parametrize("name", list(queries.oracle()))
def test_sql(spark, name):
    assert differences(queries.registry()[name](spark, FOLDER), FOLDER, queries.oracle()[name]) is None


def test_many_item_shingles(spark, monkeypatch):
    few = sorted(map(tuple, queries.op1_decontaminate(spark, FOLDER).collect()))
    monkeypatch.setattr(queries.decontamination, "BROADCAST_SHINGLES", 0)
    assert few and sorted(map(tuple, queries.op1_decontaminate(spark, FOLDER).collect())) == few


def random_text(rng, alphabet):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))


ALPHABET = [chr(x) for x in [*range(0, 0x250), *range(0x370, 0x460)]] + [*"▁😀一　 \x85\xa0\x1c\x1fİΣ́​ﬁ"] + [
    " ", "  ", "\n", "the", "ing", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<s>", "<0x0A>", "1990", "://", "_a", ");"
] * 12


def test_token_counts_are_the_library_s():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own, rng = Tokenizer.from_file(path), token_counts.Counter(path), random.Random(1)
    for _ in range(3000):
        text = random_text(rng, ALPHABET)
        assert own(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_query(spark):
    library, docs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), documents(spark)
    for r in queries.op9_token_counts(spark, FOLDER).collect():
        text = docs[r["doc_id"]]["text"]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_pieces_are_the_library_s_without_dropout_and_lossless_with():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    plain, varied, rng = sentencepiece_dropout.Codec(path, 0, 0.0, 1), sentencepiece_dropout.Codec(path, 7, 0.1, 3), random.Random(2)
    for i in range(3000):
        text = random_text(rng, ALPHABET)
        if "▁" not in text and "\0" not in text:
            assert plain.encode(text, 0) == library.encode(text), repr(text)
        assert plain.decode(plain.encode(text, 0)) == varied.decode(varied.encode(text, i % 3)) == text
        chunk = text.replace(" ", "▁")
        assert varied.encoders[0]._merged(chunk) == varied.encoders[0]._merged_by_heap(chunk)
    assert varied.encode("international understanding", 0) != varied.encode("international understanding", 1)


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        p = sharding.Permutation(n, 5)
        at = p.position(np.arange(n))
        assert sorted(at) == list(range(n)) and (p.row(at) == np.arange(n)).all()
    shard, slot = p.place(np.arange(n), 8)
    assert p.row_at(int(shard[17]), int(slot[17]), 8) == 17


def test_shard_query(spark):
    docs = documents(spark)
    order = sorted(docs)
    p = sharding.Permutation(len(order), 0)
    for r in queries.op3_shards(spark, FOLDER).collect():
        text = docs[r["doc_id"]]["text"].encode()
        at = int(p.position(np.array([order.index(r["doc_id"])]))[0])
        assert (r["size"], r["text_crc32"], r["law"], r["shard"], r["slot"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", at % 8, at // 8, None)


def simhash(text):
    words = WORD.findall(lowered(text))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Key to least key of its component, all pairs looked at."""
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3 and root(a) != root(b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in prints}


def test_simhash_query(spark):
    prints = {i: simhash(r["text"]) for i, r in documents(spark).items()}
    together = groups(prints)
    for r in queries.op5_simhash(spark, FOLDER).collect():
        assert (r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", together[r["doc_id"]])


@pytest.mark.parametrize("block", [2048, 16])
def test_links_in_dense_groups(spark, block):
    rng, values = random.Random(3), set()
    for base in [rng.getrandbits(64) for _ in range(20)]:
        for _ in range(15):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    core = rng.getrandbits(64)
    for _ in range(150):
        values.add(core ^ sum(1 << b for b in rng.sample(range(24, 44), rng.randint(0, 4))))
    signed = {int(np.uint64(v).view(np.int64)): v for v in values}
    expected = defaultdict(set)
    for k, g in groups(signed).items():
        expected[g].add(k)
    got = defaultdict(set)
    for r in simhash_dedup.components(simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long"), block)).collect():
        got[r["root"]].add(r["node"])
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_gradients():
    net = language_id.Network.fresh(["a", "b", "c"], 4, 1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    windows = np.random.default_rng(0).integers(0, 255, (3, 7)).astype(np.int16)
    windows[1, 5:] = language_id.PAD
    labels = np.arange(3)

    def loss():
        p = net.label(windows)
        return -np.log(np.stack([p[i, :, labels[i]] for i in range(3)]))[windows != language_id.PAD].mean()

    for name, grad in net.gradients(windows, labels).items():
        for flat in np.argsort(-np.abs(grad).ravel())[:3]:
            at = np.unravel_index(flat, grad.shape)
            here, step = net.weights[name][at], 1e-3
            net.weights[name][at] = here + step
            up = loss()
            net.weights[name][at] = here - step
            down = loss()
            net.weights[name][at] = here
            assert (up - down) / (2 * step) == pytest.approx(grad[at], rel=0.02, abs=1e-4)


def test_language_held_out(spark):
    docs = documents(spark)
    rows = queries.op8_language(spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) >= 0.9


def test_kneser_ney_query(spark):
    docs = documents(spark)
    tokens = {i: [*lowered(r["text"]).encode().split(), 0] for i, r in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    one, two = Counter(), Counter()
    for i, t in tokens.items():
        if not held[i]:
            one.update(t)
            two.update(zip([1, *t[:-1]], t))
    after, begun = Counter(v for _, v in two), Counter()

    def cuts(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *[k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]]

    d2, d1, total = cuts(two), cuts(after), Counter()
    for (u, _), c in two.items():
        total[u] += c
        begun[u] += d2[min(c, 3)]
    rest = sum(d1[min(c, 3)] for c in after.values()) / (len(one) + 1)
    low = lambda v: (after[v] - d1[min(after[v], 3)] + rest) / len(two)
    high = lambda u, v: (two[u, v] - d2[min(two[u, v], 3)] + begun[u] * low(v)) / total[u] if total[u] else low(v)
    assert sum(high(b"the", v) for v in one) + high(b"the", "unseen") == pytest.approx(1)
    n, v = sum(one.values()), len(one)
    for r in queries.op10_kneser_ney(spark, FOLDER).collect():
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(t), sum(one[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t))
        assert r["score"] == pytest.approx(sum(math.log10(high(a, b)) for a, b in zip([1, *t[:-1]], t)))
    assert kneser_ney.discounts([0, 1, 1, 1]) == (0.5, 1.0, 1.5)


def cheapest(roles):
    """Over all relabellings, merges and numbers of empty turns."""
    best = math.inf
    for names in itertools.product(chat_format.ROLES, repeat=len(roles)):
        changed = sum(0 if a == b else 3 if a in chat_format.ROLES else 1 for a, b in zip(roles, names))
        for merged in itertools.product((0, 1), repeat=len(roles)):
            if any(m and (i == 0 or names[i] != names[i - 1]) for i, m in enumerate(merged)):
                continue
            turns = [x for x, m in zip(names, merged) if not m]
            for extra in range(2 * len(turns) + 3):
                n = len(turns) + extra
                pairs = ["user", "assistant"] * (n // 2)
                legal = pairs if n % 2 == 0 else ["system", *pairs] if n > 1 else None
                walk = iter(legal or [])
                if legal is not None and all(any(x == y for y in walk) for x in turns):
                    best = min(best, changed + sum(merged) + 2 * extra)
                    break
    return best


def test_repairs_cost_least():
    rng = random.Random(2)
    for _ in range(60):
        roles = [rng.choice([*chat_format.ROLES, None, "bot"]) for _ in range(rng.randint(1, 4))]
        entry, leave = chat_format.chain_states([chat_format.segment_matrix(roles)])
        assert chat_format.repair(roles, ["x"] * len(roles), entry, leave, True)["cost"] == cheapest(roles)


def test_chat_segments_join(spark):
    chats = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    whole = {r["conv_id"]: (r["cost"], r["rendered"]) for r in queries.op2_chat_format(spark, FOLDER).collect()}
    cost, text = Counter(), defaultdict(str)
    for r in sorted(chat_format.format_chats(chats, segment=2).collect(), key=lambda r: r["segment"]):
        cost[r["conv_id"]] += r["cost"]
        text[r["conv_id"]] += r["rendered"]
    assert whole == {k: (cost[k], text[k]) for k in text}


def test_ties_have_one_order_in_long_and_short_chats(spark):
    """Messages of one turn and role stand in the order of their texts, in one piece or many."""
    chats = spark.createDataFrame([(1, 0, "user", t) for t in "gbdfcae"] + [(1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    whole = chat_format.format_chats(chats).collect()[0]["rendered"]
    assert re.findall(r"^([a-g])(?:<.end.>)?$", whole, re.MULTILINE) == [*"abcdefg"]
    for segment in (1, 2, 3):
        assert "".join(r["rendered"] for r in sorted(chat_format.format_chats(chats, segment=segment).collect(), key=lambda r: r["segment"])) == whole


def test_chat_query_costs_least(spark):
    """op2's costs and counts against all repairs of the short conversations."""
    roles = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect():
        roles[r["conv_id"]].append(r["role"])
    rows = queries.op2_chat_format(spark, FOLDER).collect()
    assert {r["conv_id"] for r in rows} == set(roles)
    short = [r for r in rows if r["n_messages"] <= 4]
    assert len(short) > 20
    for r in short:
        assert r["n_messages"] == len(roles[r["conv_id"]]) and r["cost"] == cheapest(roles[r["conv_id"]])


def test_pipeline_by_stage(spark):
    """Each stage's rows follow from its input by the plain versions above."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(cut(stage(spark, tables[-1], FOLDER)))
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables]
    letters = {r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"]))}
    assert ids[1] <= letters and len(ids[1]) >= 0.95 * len(letters)
    assert ids[2] == ids[1]
    prints = {r["doc_id"]: simhash(r["text"]) for r in tables[2].collect()}
    assert ids[3] == set(groups(prints).values())
    leaked = {r["doc_id"] for r in queries.op1_decontaminate(spark, FOLDER).collect()}
    assert ids[4] == ids[3] - leaked == ids[5]
    assert tables[5].where("not lossless").count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()} == ids[5]
