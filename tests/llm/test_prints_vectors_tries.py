"""Winnowing, whitening and the prefix trie against brute force, and on odd input."""

import hashlib
import io
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from parcelmill.llm import gru_lm, html_wrappers, license_rules, prefix_trie, whitening, winnowing

DOCS = "doc_id long, text string, next_text string, bucket string, fingerprint long"
TURNS = "conv_id long, turn long, role string, text string, depth long, length string, d1 long"
VECTORS = "vec_id long, embedding array<float>, label int, index long, x string"


# --- winnowing -----------------------------------------------------------------------------------------------------


def winnowed(text, k=winnowing.GRAM, w=winnowing.WINDOW):
    mask = (1 << 60) - 1
    hashes = [int(hashlib.md5(u.encode()).hexdigest()[:15], 16) for u in re.findall(winnowing.UNIT, (text or "").lower())]

    def rolled(some):
        acc = 0
        for x in some:
            acc = ((acc << 1 & mask) | acc >> 59) ^ x
        return acc

    grams = [rolled(hashes[i : i + k]) for i in range(max(1, len(hashes) - k + 1))] if hashes else []
    out = []
    for i in range(max(1, len(grams) - w + 1)) if grams else []:
        window = grams[i : i + w]
        place = i + max(j for j, x in enumerate(window) if x == min(window))
        if not out or out[-1][0] != place:
            out.append((place, grams[place]))
    return out


def jaccard(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_by_brute_force(rows):
    hash_of = {t: h for t, h in zip(*[[r[i] for r in rows] for i in (1, 2)], strict=True)}
    rows = sorted(((d, t or "") for d, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hash_of.get(r[1], hash_of.get(None)), r[1]))
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b = winnowed(text), winnowed(edited)
        out.append((doc_id, len(text), edited, tuple(a), tuple(b), jaccard(a, b), jaccard(a, winnowed(following))))
    return sorted(out, key=repr)


def edited_by_library(df):
    got = winnowing.edited_documents(df).select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    return sorted(((*r[:3], *(tuple(map(tuple, f)) for f in r[3:5]), *r[5:]) for r in got), key=repr)


def with_hashes(df):
    hashed = df.select("doc_id", "text", F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1))
    return [tuple(r) for r in hashed.collect()]


def test_edited_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert edited_by_library(docs) == edited_by_brute_force(with_hashes(docs))


@pytest.fixture(scope="module")
def odd_docs(spark):
    long_text = " ".join(f"w{i * i % 977}" for i in range(60_000))
    texts = [None, "", " \n\t", "one", "a b c d", "a b c d e", "same " * 50, long_text, "漢字かな交じり文" * 9, "ÉCOLE été naïve 🙂 <b> " * 7]
    rows = [(k, t, "x", "y", 7) for k, t in enumerate(texts)]
    rows += [rows[7], rows[7], rows[6], (None, "no id", None, None, None), (None, "none either", None, None, None), (None, None, None, None, None)]
    rows += [(50, f"text number {i} of one id", None, None, None) for i in range(300)] + [(50, "twice", None, None, None)] * 2
    return spark.createDataFrame(rows, DOCS)


def test_edited_odd_documents(odd_docs):
    got = edited_by_library(odd_docs)
    assert got == edited_by_brute_force(with_hashes(odd_docs))
    assert {g[5] for g in got if g[1] == 0} == {1.0}


def test_edited_few_documents(spark):
    assert edited_by_library(spark.createDataFrame([], DOCS)) == []
    alone = edited_by_library(spark.createDataFrame([(3, "abcdef", None, None, None)], DOCS))
    assert [(g[0], g[2], g[6]) for g in alone] == [(3, "abcdab", 1.0)]


@pytest.mark.parametrize(("k", "w"), [(1, 1), (2, 3), (3, 4), (5, 16), (6, 7), (7, 10)])
def test_any_gram_and_window(k, w, odd_docs):
    got = odd_docs.filter("doc_id < 10").select("text", winnowing.fingerprint(F.col("text"), k, w)).collect()
    assert [[tuple(e) for e in print_] for _, print_ in got] == [winnowed(t, k, w) for t, _ in got]


def test_match_guarantee(spark):
    words = [f"q{i}" for i in range(400)]
    shared = words[100 : 100 + winnowing.GRAM + winnowing.WINDOW - 1]
    texts = [" ".join(words), "before " * 30 + " ".join(shared) + " after" * 30]
    a, b = spark.createDataFrame(enumerate(texts), "doc_id int, text string").transform(winnowing.fingerprints).orderBy("doc_id").collect()
    assert {h for _, h in a.fingerprint} & {h for _, h in b.fingerprint}


# --- whitening -----------------------------------------------------------------------------------------------------


def test_whitened_by_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 16)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    table = table.unionByName(table.filter("vec_id < 9").withColumn("vec_id", F.col("vec_id") + 100_000))  # vectors that come twice
    x = {r.vec_id: [int(np.floor(256 * v)) for v in r.embedding] for r in table.collect()}
    fit = np.array(sorted(set(map(tuple, x.values()))))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, vectors = (v[..., ::-1] for v in np.linalg.eigh(covariance))
    got = whitening.by_component(whitening.whiten(table)).toPandas()
    assert sorted(got["vec_id"]) == sorted(4 * list(x)) and (got["n"] == n).all()
    for vec_id, deviation in got.groupby("vec_id")["deviation"].first().items():
        assert deviation == sum((n * v - int(s)) ** 2 for v, s in zip(x[vec_id], sums, strict=True))
    for k, part in got.groupby("component"):
        want = np.array([(np.array(x[i]) - sums / n) @ vectors[:, k - 1] for i in part["vec_id"]]) / np.sqrt(values[k - 1])
        assert min(np.abs(part["whitened"] - want).max(), np.abs(part["whitened"] + want).max()) < 1e-9
        assert part["explained"].to_numpy() == pytest.approx(values[k - 1] / np.trace(covariance))
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9


def test_whiten_odd_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.5]), (2, [0.0, 1.0, 0.25]), (3, [0.5, 0.5]), (4, None), (5, [1.0, None, 0.0]), (6, [float("nan"), 0.0, 0.0])]
    rows += [(7, [float("inf"), 0.0, 0.0]), (1, [1.0, 0.0, 0.5]), (None, [0.25, 0.25, 0.0]), (8, []), (9, [-0.0, 0.001, 0.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, 1, 5, "x") for r in rows], VECTORS)).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "2", "3", "8", "9", "None"]
    # (8, []) and (9, …) are both all zeros, and stand in the fit list as [] and [0, 0, 0]
    assert {r.n for r in got} == {6} and {len(r["values"]) for r in got} == {3}


def test_whiten_without_components(spark):
    equal = spark.createDataFrame([(1, [0.5, 0.5], 0, 0, ""), (2, [0.5, 0.5], 0, 0, "")], VECTORS)
    assert [(r.n, r.deviation, r["values"]) for r in whitening.whiten(equal).collect()] == [(1, 0, [])] * 2
    assert whitening.whiten(equal.limit(0)).collect() == [] and whitening.by_component(whitening.whiten(equal)).collect() == []
    huge = spark.createDataFrame([(1, [3e38], 0, 0, ""), (2, [-3e38], 0, 0, "")], VECTORS)
    assert {r.deviation for r in whitening.whiten(huge).collect()} == {None}


# --- prefix trie ---------------------------------------------------------------------------------------------------


def trie_by_brute_force(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            text = text or ""
            convs[conv_id].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest(), text))
    original = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(original.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1].encode().split()) if node else 0
    ends = {n: ",".join(str(c) for c in ids if len(rebuilt[c]) == len(n)) for n, ids in members.items()}
    out = [
        (ids[0], len(n), members[n[:-1]][0] if n else None, len(ids), children.get(n, 0), leaves[n], saved[n], hashlib.sha256(ends[n].encode()).hexdigest())
        for n, ids in members.items()
    ]
    return sorted(out, key=repr)


def trie_by_library(df):
    return sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=repr)


def test_trie(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert trie_by_library(turns) == trie_by_brute_force([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


@pytest.fixture
def odd_turns(spark):
    rows = [(c, t, "user", f"say {t} x") for c in range(60) for t in range(c % 7)]
    rows += [(20, None, None, None), (20, None, "", ""), (40, 1, "user", None), (None, 1, "user", "nobody"), (None, None, None, None), (-25, 3, "system", "a b")]
    rows += [(21, 0, "user", "long " * 30_000), (22, 2, "tie", "b"), (22, 2, "tie", "a"), (22, 2, "tie", "a"), (23, -4, "user", "first\ttwo words")]
    rows += [(c, t, "user", "copy") for c in range(1000, 1300) for t in (0, 1)] + [(5000, t, "assistant", f"turn {t % 9}") for t in range(700)]
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)


@pytest.mark.parametrize(("light", "per_shard", "span"), [(20_000, 200_000, 4096), (5, 20, 3), (60, 1000, 64)])
def test_trie_of_odd_turns(odd_turns, light, per_shard, span, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LIGHT", light)
    monkeypatch.setattr(prefix_trie, "NODES_PER_SHARD", per_shard)
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    monkeypatch.setattr(prefix_trie, "IDS_PER_ROW", 7)
    assert trie_by_library(odd_turns) == trie_by_brute_force([tuple(r)[:4] for r in odd_turns.collect()])


def test_trie_of_nothing(odd_turns):
    assert trie_by_library(odd_turns.limit(0)) == [] and trie_by_library(odd_turns.filter("conv_id IS NULL")) == []


def test_slots():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.int64).view(np.uint64)
    table = prefix_trie.Slots(keys)
    assert sorted(table.of(keys)) == list(range(5000))
    assert (table.of(keys + np.uint64(1)) == -1).all() and len(prefix_trie.Slots(keys[:0]).of(keys[:0])) == 0
    with pytest.raises(ValueError, match="repeated"):
        prefix_trie.Slots(np.concatenate([keys, keys[:1]]))


def test_accumulated_deep_chain():
    n = 20_000
    chain = pd.DataFrame({"depth": range(n), "d1": range(1, n + 1), "d2": 5, "p1": range(n), "p2": 5, "own_saved": 1})
    out = prefix_trie.accumulated(chain.assign(below_children=0, below_leaves=0, below_saved=0))
    assert list(out["saved_tokens"]) == list(range(n, 0, -1)) and set(out["n_leaves"]) == {1} and list(out["n_children"]) == [1] * (n - 1) + [0]
    assert out["top"].sum() == 1 and out["top"][0]


# --- language model: a very long text beside short ones ---------------------------------------------------------------


def test_long_text_is_scored_as_if_alone():
    words = [f"w{i}".encode() for i in range(50)]
    net = gru_lm.Network(words, np.array([*range(60, 10, -1), 7], np.float64))
    texts = [" ".join(f"w{i * i % 53}" for i in range(n)) for n in (20_000, 3, 700, 64, 63, 65, 0, 1, 64)] + ["w1 w2"] * 300
    docs = [net.encode(t) for t in texts]
    net.train(docs)
    together = net.score(docs)
    assert together == pytest.approx([net.score([d])[0] for d in docs], rel=1e-4)


# --- deep pages, and many phrases ---------------------------------------------------------------------------------------


def test_deep_pages_keep_their_text(spark):
    lead = "<html><body><div><p>An opening line that is long enough to be read.</p>"
    pages = [
        lead + "<div>" * 10_000 + "<p>the deepest line</p>" + "</div>" * 10_000 + "<p>the last line</p></div></body></html>",
        lead + "<b class=x>" * 3000 + "bold to the end<p>the last line",
        lead + "<ul><li>" * 2000 + "an item",
    ]
    rows = [(k, f"http://deep.example/{k}", p) for k, p in enumerate(pages * 2)]
    got = {r.page_id: r.text for r in html_wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, ends in enumerate([("the deepest line", "the last line"), ("bold to the end", "the last line"), ("an item",)] * 2):
        assert all(e in got[k].split("\n") for e in ends), got[k][:200]


def test_phrases_by_brute_force():
    rng = np.random.default_rng(3)
    words = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "x"]
    for size in [0, 1, 2, 50, 4000]:
        given = [words[i] for i in rng.integers(0, len(words), size)]
        n, first, last, labels = license_rules.phrases(b" %b " % " ".join(given).encode())
        want = [(i, label) for p, label in license_rules.PHRASES.items() for i in range(size) if given[i : i + len(p.split())] == p.split()]
        assert (n, labels) == (len(want), {x for _, x in want})
        assert (first, last) == ((min(i for i, _ in want), max(i for i, _ in want)) if want else (None, None))


def test_words_and_chunks_by_arrow():
    """Words cut by kernels, ids and a chunk's postings are those of the plain definition; a chunk without words too."""
    texts = [None, "", "  ", "A\x0bB\x1cc d \n", "É a b", "the the of", "x" * 5000 + " The"]
    column = pa.array(texts, pa.string())
    words, sizes = gru_lm.words_by_text(column)
    assert [len(gru_lm.tokens(t)) - 1 for t in texts] == sizes.tolist()
    assert [w for t in texts for w in gru_lm.tokens(t)[:-1]] == words.to_pylist()
    net = gru_lm.Network([b"the", gru_lm.END, b"of"], np.array([5.0, 4, 3, 9]))
    assert [d.tolist() for d in net.encode_all(column)] == [net.encode(t).tolist() for t in texts]
    learned = [k % 2 == 0 for k in range(len(texts))]
    for n in (len(texts), 3):  # the first three have no words
        keys = pa.array(range(n), pa.int64())
        batch = pa.RecordBatch.from_arrays([keys, keys, column.slice(0, n), pa.array(learned[:n])], ["doc_key", "text_key", "text", "learned"])
        rows = [r for b in gru_lm._chunk_rows([batch]) for r in b.to_pylist()]
        counts = Counter(t for k in range(n) for t in gru_lm.tokens(texts[k]))
        train = Counter(t for k in range(n) if learned[k] for t in gru_lm.tokens(texts[k]))
        assert {r["word"]: r["train"] for r in rows if r["word"] is not None} == {w: train[w] for w in counts}
        place = {r["place"]: r["word"] for r in rows if r["word"] is not None}
        with np.load(io.BytesIO(zstandard.decompress(rows[-1]["postings"]))) as held:
            owner = np.repeat(np.arange(n), held["sizes"])
            found = {(d, place[i]): c for d, i, c in zip(owner.tolist(), held["ids"].tolist(), held["ns"].tolist(), strict=True)}
        assert found == {(k, w): c for k in range(n) for w, c in Counter(gru_lm.tokens(texts[k])).items()}
