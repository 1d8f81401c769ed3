"""The text operators against brute force, and on nulls, empty tables, ties and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from parcelmill.llm import byte_bpe, gru_lm, html_wrappers, impact_topk, license_rules, near_copies, quality_ledger, simhash_ring, source_mix, subword_classifier, unit_dedup
from parcelmill.llm.queries import ORACLES, PATTERN, QUERIES, RANKS
from tools.check_oracle import compare, connect

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, target double, fp long, document string"
LONG = "alpha beta gamma. " * 4000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    texts = [None, "", " \n\t", "one two three four five six seven eight nine ten eleven", LONG, "naïve ŒUVRE 漢字 🙂 %%% <b>", "A b. A b. A b."]
    rows = [(k, t, "en", s, 1, 7, 0.5, 9, "x") for k, (t, s) in enumerate(zip(texts, ["a", "a", "b", None, "b", "c", "a"], strict=True))]
    rows += [rows[3], rows[3], (None, "no id here at all", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("key", list(ORACLES))
def test_oracle(key, spark, sf_dir):
    assert compare(QUERIES[key](spark, sf_dir), connect(sf_dir), ORACLES[key]) is None


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def reference_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [reference_print(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)].append(d)
    return sorted(((d, f"{p:016x}", min(least[root(i)], default=None)) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=repr)


def test_simhash(spark, docs, odd, empty):
    for frame in (docs.limit(150), odd):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        got = simhash_ring.near_duplicates(frame).select("doc_id", simhash_ring.hex_fingerprint(), "component_id").collect()
        assert sorted(map(tuple, got), key=repr) == brute_components(rows)
    assert simhash_ring.near_duplicates(empty).count() == 0
    assert sorted(r["doc_id"] is None for r in simhash_ring.one_per_component(odd).collect()).count(True) <= 1
    assert simhash_ring.one_per_component(odd).columns == odd.columns


def test_ring_links(spark):
    """Links of random fingerprints, with blocks far smaller than a group of near ones, keep all components."""
    rng = np.random.default_rng(1)
    seeds = rng.integers(-(2**62), 2**62, 40)
    prints = {int(s) for s in seeds}
    for s in seeds:
        x = int(s)
        for _ in range(12):
            for bit in rng.choice(63, rng.integers(1, 4), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    prints = sorted(prints)
    got = {r["node"]: r["root"] for r in simhash_ring.components(simhash_ring.links(spark.createDataFrame([(p,) for p in prints], "fp long"), block=8)).collect()}
    up = {p: p for p in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3 and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                up[high] = low
    assert all(got.get(p, p) == root(p) for p in prints)


def grams(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies(spark, empty):
    """The near-dedup stage leaves no two texts of five-word Jaccard 0.8 or more, with blocks of any size, and joins no others."""
    rng = np.random.default_rng(3)
    texts = []
    for k in range(40):
        words = [f"w{n}" for n in rng.integers(0, 5000, 60 + 4 * k)]
        for edits in (0, 1, 1, 2, 2, 3, 5, 9):
            for at in rng.choice(len(words), edits, replace=False):
                words[at] = f"x{rng.integers(0, 10**9)}"
            texts.append(" ".join(words))
    sets = [grams(t) for t in texts]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    up = list(range(len(texts)))
    for i, j in near:
        old, new = max(up[i], up[j]), min(up[i], up[j])
        up = [new if u == old else u for u in up]
    frame = spark.createDataFrame(list(enumerate(texts)), "text_key long, text string")
    rooted = frame.select("text_key", F.col("text_key").alias("root"))
    for block in (3, 2048):
        got = {r["node"]: r["root"] for r in simhash_ring.components(near_copies.links(frame, rooted, block)).collect()}
        assert [got.get(k, k) for k in range(len(texts))] == up
    kept = {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, frame.withColumnRenamed("text_key", "doc_id"), "").collect()}
    assert kept <= set(up) and not any(i in kept and j in kept for i, j in near)
    assert corpus_pipeline.simhash_near_dedup(spark, empty, "").count() == 0


def test_bpe(spark, docs, odd, empty):
    ranks = byte_bpe.read_ranks(spark, RANKS)
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for frame in (docs, odd):
        for text, n, ids, a, b in byte_bpe.encode_documents(frame, RANKS, PATTERN, doc_id="text").collect():
            want = whole.encode_ordinary(text or "")
            assert (n, list(ids)) == (len(want), want)
            assert a == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
            assert b == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.encode_documents(empty, RANKS, PATTERN).count() == 0


def test_bpe_fuzz(spark):
    ranks = byte_bpe.read_ranks(spark, RANKS)
    own = byte_bpe._Vocabulary(ranks, PATTERN)
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(3)
    parts = ["a", "b", "é", "ing", "the", " ", "\n", "'s", "12", "!!", "%%%", "漢", "🙂", "\x00", "xx"]
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(0, 50)))
        assert [i for piece in own.encode(text) for i in piece] == whole.encode_ordinary(text)


def brute_units(rows):
    """Dedup with plain dictionaries: the earliest document of each unit, then lines and runs."""
    first = {}
    for d, t in rows:
        for *_, digest in unit_dedup.units(t):
            first[digest] = min(first.get(digest, math.inf), math.inf if d is None else d)
    out = []
    for d, t in rows:
        seen, gone, run = set(), set(), []

        def end(run, gone):
            if sum(u[4] for u in run) >= unit_dedup.RUN_WORDS:
                gone |= set(range(run[0][2], run[-1][3]))
            run.clear()

        for u in sorted(unit_dedup.units(t), key=lambda u: (u[2], -u[3], u[0])):
            own = first[u[5]] == (math.inf if d is None else d) and u[5] not in seen
            seen.add(u[5])
            if u[0] & 1 and not own and u[4] >= unit_dedup.LINE_WORDS:
                gone |= set(range(u[2], u[3]))
            if u[0] & 2:
                if own:
                    end(run, gone)
                else:
                    run.append(u)
        end(run, gone)
        for k in range(1, len(t or "")):
            if k - 1 in gone and t[k].isspace():
                gone.add(k)
        out.append((d, None if t is None else "".join(c for k, c in enumerate(t) if k not in gone)))
    return sorted(out, key=repr)


def test_units(spark, docs, odd, empty):
    passage = "Here stands a passage of words. It goes on for long enough. It has sentences of its own, and more words than twenty."
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] + [(5000, f"x y {passage} z"), (5001, f"other words {passage}"), (5001, f"other words {passage}")]
    rows += [tuple(r) for r in odd.select("doc_id", "text").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = unit_dedup.dedup_units(frame)
    assert sorted((tuple(r) for r in got.select("doc_id", "text").collect()), key=repr) == brute_units(rows)
    assert {r["text"] for r in got.filter("doc_id = 5001").collect()} == {"other words "}
    for r in got.filter("removed_chars > 0").select("document.text", F.col("text").alias("kept"), "removed").collect():
        at, kept = 0, ""
        for a, b in r["removed"]:
            kept, at = kept + r["text"][at:a], b
        assert kept + r["text"][at:] == r["kept"]
    assert unit_dedup.dedup_units(empty).count() == 0


def test_rules(odd, empty):
    stored = quality_ledger.ledger(odd).withColumn("kept", quality_ledger.passes())
    by_id = {r["doc_id"]: r for r in stored.collect()}
    assert (by_id[0]["n_words"], by_id[0]["kept"]) == (0, False)
    assert (by_id[3]["n_words"], by_id[3]["kept"]) == (11, True)
    assert by_id[4]["n_repeat_words"] == 12000
    failed = {r["rule"]: r["failed"] for r in quality_ledger.ablation(stored).collect()}
    assert failed == {k: sum(bool(r["fail_bits"] & b) for r in stored.collect()) for k, b in quality_ledger.BITS.items()}
    assert quality_ledger.ledger(empty).count() == 0


def test_mix(odd, empty):
    rows = source_mix.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
    assert source_mix.mix(empty).count() == 0
    assert source_mix.mixed_documents(odd).columns == odd.columns


def brute_topk(rows, k=20):
    sound = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in sound.items():
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in sound.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_topk(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(60)]  # ties
    rows += [(400, None), (420, [float("nan")] * 8), (440, [None] * 8), (460, [float("inf")] * 8), (480, []), (None, [0.1] * 8), (500, [1e6] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = impact_topk.search_embeddings(frame.withColumn("id", F.lit(1)).withColumn("v", F.lit(2)))
    assert sorted(map(tuple, found.collect())) == brute_topk(rows)
    small = frame.select(F.col("vec_id").alias("id"), impact_topk.components(F.col("embedding")).alias("v")).filter("id is not null and v is not null")
    blocks = impact_topk.search(small, small.filter("id % 20 = 0"), 20, rows_per_block=50, queries_per_block=5)
    assert sorted(map(tuple, blocks.collect())) == brute_topk(rows)
    assert impact_topk.search_embeddings(frame.filter("false")).count() == 0


def test_licenses(odd, empty):
    assert len(license_rules.rules()) >= 300
    found = license_rules.scan("Licensed under the GNU General Public License, version 3. All rights reserved; CC-BY, cc by cc by")
    assert (found["n_base"], found["first_word"], found["last_word"], found["base_labels"]) == (5, 4, 16, "cc-by,gpl,reserved")
    assert "gpl-3.0" in found["labels"] and 0 <= found["score"] <= 1
    assert [d["rule"] for d in found["detections"] if d["rule"].startswith("gpl")] == ["gpl-3.0:grant"]
    assert license_rules.scan_licenses(odd).filter("n_words = 0 and labels = '' and first_word is null").count() == 4
    assert license_rules.scan_licenses(empty).count() == 0


def forms(tree):
    """Texts of a parsed regular expression: every alternative, optional parts absent and present."""
    out = [""]
    for op, value in tree:
        match str(op):
            case "LITERAL":
                options = [chr(value)]
            case "NOT_LITERAL":
                options = ["q"]
            case "SUBPATTERN":
                options = forms(value[3])
            case "BRANCH":
                options = [f for branch in value[1] for f in forms(branch)]
            case "MAX_REPEAT" | "MIN_REPEAT":
                options = ([""] if value[0] == 0 else []) + [f * max(1, value[0]) for f in forms(value[2])]
            case "IN":
                options = ["q" if str(value[0][0]) == "NEGATE" else " " if str(o) == "CATEGORY" else chr(v[0] if str(o) == "RANGE" else v) for o, v in value[:2]]
            case "AT" | "ASSERT" | "ASSERT_NOT":
                options = [""]
        out = [a + b for a in out for b in options]
    return out


def test_license_gate():
    """The gate opens the rule of every text that a rule's alternatives make, whatever its white space; detections agree with all rules run."""
    blanks = [" ", "  ", "\n ", "\r\n", "\t", "\u00a0", "\x1c", "\u2003\n"]
    n = 0
    for k, rule in enumerate(license_rules.rules()):
        for text in forms(re._parser.parse(rule.pattern.pattern)):
            n += 1
            text = "x " + text.replace(" ", blanks[n % len(blanks)]) + " y"
            if rule.pattern.search(text):
                assert k in license_rules.opened(text), (rule.name, text)
                if n % 97 == 0:
                    assert license_rules.detections(text) == license_rules.detections(text, gated=False)
    assert "gpl-3.0" in license_rules.scan("under the GNU General\n   Public License, version 3")["labels"]
    for text, label in (("PSF license", "python-2.0"), ("Open Data Commons Database License", "odbl-1.0"), ("must not be copied without prior written permission", "proprietary")):
        assert label in license_rules.scan(text)["labels"].split(",")


def test_classifier(spark, sf_dir, odd, empty):
    documents, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = subword_classifier.score_quality(documents, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in scored) >= 0.9 * len(scored)
    assert all(0 <= r["score"] <= 1 for r in subword_classifier.score_quality(odd, labels).collect())
    assert subword_classifier.score_quality(empty, labels).count() == 0
    assert {r["score"] for r in subword_classifier.score_quality(odd, labels.filter("false")).collect()} == {0.5}


def test_language_model(docs, odd, empty):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter(t for d, text in rows if not held[d] for t in gru_lm.tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in gru_lm.score_documents(docs).collect()}
    for d, text in rows:
        ts, r = gru_lm.tokens(text), got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(ts), sum(counts[t] > 0 for t in ts), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in ts))
        assert r["score"] < 0
    assert gru_lm.score_documents(odd).filter("score < 0 and n_tokens >= 1").count() == odd.count()
    assert gru_lm.score_documents(empty).count() == 0


def test_language_model_beats_counts(spark):
    """On held-out documents the network is worth more than the counts alone."""
    scored = gru_lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    base, model = scored.selectExpr("sum(base_score)", "sum(score)").first()
    assert model > base


def test_language_model_learns_from_all(spark, docs, monkeypatch):
    """Over all rounds, the network learns from every training row once and from no other."""
    taken = []
    rows_of = gru_lm.learning_rows
    monkeypatch.setattr(gru_lm, "learning_rows", lambda rows, k: taken.append(rows_of(rows, k).select("doc_id", "text_key")) or rows_of(rows, k))
    gru_lm.score_documents(docs)
    learned = sorted(r["doc_id"] for part in taken for r in part.collect())
    assert learned == sorted(r["doc_id"] for r in docs.select("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2)


def test_network():
    """Probabilities sum to one, windows do not change a score, and learning raises it."""
    words = [gru_lm.END, *[b"w%d" % k for k in range(60)]]
    net = gru_lm.Network(words, np.arange(len(words) + 1, 0, -1, dtype=float))
    state = np.full((len(words) + 1, gru_lm.WIDTH), 0.3, np.float32)
    assert np.exp(net.output(state, np.arange(len(words) + 1))[0]).sum() == pytest.approx(1, abs=1e-4)
    docs = [np.array([k % 7 + 1, k % 7 + 2] * 40 + [0], np.int32) for k in range(60)]
    before = net.score(docs)
    assert net.score([docs[0]])[0] == pytest.approx(before[0], rel=1e-4)
    net.train(docs)
    assert net.score(docs).sum() > before.sum()


PAGE = """<html><body class="has-sidebar"><header><a href=/>Home</a></header><nav><ul><li>Menu</ul></nav>{0}
<div class="cookie-notice">We use</div><form>f</form><aside>s</aside><footer>c {1}</footer></body></html>"""


def test_wrappers(spark):
    body = "<h1>T &lt;x&gt;</h1><p>One&nbsp;two<br>three <a href=x>link</a> end.<ul><li>a<li>b {0}</ul><div class='comments'><p>bad</p></div><script>var x='</p>'</script>"
    rows = [(k, f"https://h.example/{k}", PAGE.format(f"<article>{body.format(k)}</article>", k)) for k in range(4)]
    rows += [(k, f"https://g.example/{k}", PAGE.format(f"<div id='content'>{body.format(k)}</div>", k)) for k in range(10, 14)]
    rows += [(20, None, None), (21, "no address", ""), (22, "https://h.example/x", "<p>only <b>text"), (None, "https://h.example/y", "<" * 50 + "a" * 50)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in html_wrappers.extract_pages(frame).collect()}
    for k in (0, 1, 2, 3, 10, 11, 12, 13):
        assert got[k]["text"] == f"T <x>\nOne two three link end.\na\nb {k}"
    assert (got[20]["text"], got[20]["n_chars"], got[21]["text"], got[22]["text"]) == ("", 0, "", "only text")
    assert html_wrappers.extract_pages(frame.filter("false")).count() == 0


def test_bare_article_text(spark):
    """Text that stands in an article or main element itself belongs to it, before its first block and after."""
    bodies = ["<article>Lead {0}<p>More</p>tail</article>", "<article> <b>Lead</b> {0}<p>More</p>tail</article>", "<main>Lead {0}<p>More</p>tail</main>",
              "<div role=main>Lead {0}<p>More</p><div>tail</div></div>", "<article><div>Lead <i class=x>{0}</i></div><p><em class=y>More</em></p>tail</article>"]
    rows = [(10 * h + k, f"https://h{h}.example/{k}", PAGE.format("Before" + body.format(k) + "After", k)) for h, body in enumerate(bodies) for k in range(4)]
    got = html_wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {10 * h + k: f"Lead {k}\nMore\ntail" for h in range(len(bodies)) for k in range(4)}


def test_alignment():
    """What one page has and another has not becomes optional, neighbours of equal kind repeated, other texts slots."""
    one = html_wrappers.skeleton("<div><h1>A</h1><p>x</p></div>")
    two = html_wrappers.skeleton("<div><h1>A</h1><p>y</p><p>z</p><table><tr><td>t</table></div>")
    items = [html_wrappers._filled(html_wrappers.json.loads(s), iter(t), 1) for s, t in (one, two)]
    div = html_wrappers.aligned(*items)[0]
    assert [(i[0], i[1], i[2]) for i in div[4]] == [("h1", False, False), ("p", False, True), ("table", True, False)]
    assert div[4][0][4][0][5] is not None and div[4][1][4][0][5] is None


def test_pipeline(spark, sf_dir, odd):
    """Every stage of the pipeline against brute force on the small table."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    kept = [(d, t) for d, t in rows if quality(t)]
    groups = defaultdict(list)
    for (d, _, c) in brute_components(kept):
        groups[c].append(d)
    unique = {min(g) for g in groups.values()}
    cut = [(d, t) for d, t in brute_units([r for r in kept if r[0] in unique])]
    whole = {d: t for d, t in cut if t.split()}
    out = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert {r["doc_id"] for r in out} <= set(whole)
    for r in out:
        assert r["decoded_sha256"] == hashlib.sha256(whole[r["doc_id"]].encode()).hexdigest()
    assert max(Counter(r["doc_id"] for r in out).values()) <= 2
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd.columns
    nothing = odd.filter("false")
    assert all(stage(spark, nothing, sf_dir).count() == 0 for _, stage in corpus_pipeline.STAGES)


def quality(text):
    m = dict(zip(quality_ledger.MEASURES, quality_ledger.measure(text), strict=True))
    return not any(rule(m) for rule in quality_ledger.RULES.values())
