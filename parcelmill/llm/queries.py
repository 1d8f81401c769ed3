"""Queries of the text operators with production settings, and their DuckDB SQL where there is one."""

import public_tokenizers
from pyspark.sql import functions as F

from parcelmill.llm import byte_bpe, gru_lm, html_wrappers, impact_topk, license_rules, prefix_trie, quality_ledger, simhash_ring, source_mix, subword_classifier, unit_dedup, whitening, winnowing
from parcelmill.llm.common import table

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_wrapper_text(spark, sf_dir):
    return html_wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op2_unit_dedup(spark, sf_dir):
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["stop"]))
    return unit_dedup.dedup_units(table(spark, sf_dir, "documents")).select("doc_id", "text", F.array_join(spans, ",").alias("removed"), "removed_chars")


def op3_quality_ledger(spark, sf_dir):
    return quality_ledger.ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_ledger.passes("base")).alias("base_failed"), quality_ledger.passes("v1").alias("kept"), "fail_bits",
    )


def op4_impact_topk(spark, sf_dir):
    return impact_topk.search_embeddings(table(spark, sf_dir, "embeddings"))


def op5_license_rules(spark, sf_dir):
    return license_rules.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op6_subword_quality(spark, sf_dir):
    return subword_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_ring(spark, sf_dir):
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash_ring.hex_fingerprint().alias("fingerprint"), "component_id"
    )


def op8_gru_score(spark, sf_dir):
    return gru_lm.score_documents(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), RANKS, PATTERN, with_ids=False)


def op10_source_mix(spark, sf_dir):
    return source_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_winnowing(spark, sf_dir):
    return winnowing.edited_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.as_text(F.col("fingerprint")).alias("fingerprint"), winnowing.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op12_block_whitening(spark, sf_dir):
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


OP3_SQL = r"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM numbered
),
starts AS (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5),
windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]) AS n FROM starts),
repeated AS (
    SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM windows, (SELECT unnest(range(0, 5)) AS k) WHERE n > 1 GROUP BY rid
),
measured AS (
    SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
        len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) AS n_stutter,
        length(text) - length(replace(text, '!', '')) AS n_exclaims
    FROM split LEFT JOIN repeated USING (rid)
),
judged AS (
    SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 5 * n_stutter > n_words THEN 64 ELSE 0 END + CASE WHEN 2 * n_exclaims > n_words THEN 128 ELSE 0 END AS fail_bits
    FROM measured
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
    fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits
FROM judged
"""

OP4_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
    FROM whole q JOIN whole d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP10_SQL = r"""
WITH sized AS (
    SELECT doc_id, coalesce('s' || source, 't') AS label, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || coalesce(text, '-')) AS key
    FROM documents
),
sources AS (
    SELECT label, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY label) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
    FROM sized GROUP BY label
),
levels AS (
    SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - 2 * coalesce(sum(source_size) OVER w, 0))
        / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER w, 0)) AS level
    FROM sources
    WINDOW w AS (ORDER BY source_size / weight, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (SELECT label, source_size, least(CAST(2 * source_size AS DOUBLE), (SELECT max(level) FROM levels) * weight) AS target FROM levels),
budgets AS (
    SELECT *, CAST(round(target) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets
),
placed AS (
    SELECT doc_id, size, source_size, target, epochs, budget - epochs * source_size AS rest,
        coalesce(sum(size) OVER (PARTITION BY label ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized JOIN budgets USING (label)
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM placed
"""

OP11_SQL = (
    r"""
WITH ordered AS (
    SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, coalesce(text, '')) AS r, doc_id, coalesce(text, '') AS text FROM documents
),
beside AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY r), first_value(text) OVER (ORDER BY r)) AS next_text, length(text) // 3 AS third,
        coalesce(lead(r) OVER (ORDER BY r), 1) AS next_r
    FROM ordered
),
texts AS (
    SELECT r, 0 AS kind, text FROM beside
    UNION ALL SELECT r, 1, left(text, length(text) - third) || left(next_text, third) FROM beside
),
units AS (SELECT r, kind, list_transform(regexp_extract_all(lower(text), '{unit}'), lambda u: ('0x' || left(md5(u), 15))::BIGINT) AS h FROM texts),
grams AS (
    SELECT r, kind, len(h) AS n_units, p, list_reduce(
        list_prepend(0::BIGINT, h[p + 1 : p + 5]), lambda a, x: xor(((a & 576460752303423487) << 1) | (a >> 59), x)) AS hash
    FROM units, unnest(range(greatest(len(h) - 4, least(len(h), 1)))) AS t(p)
),
windows AS (
    SELECT r, kind, n_units, p, -(min({{'hash': hash, 'back': -p}}) OVER (PARTITION BY r, kind ORDER BY p ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING)).back AS place
    FROM grams
),
chosen AS (SELECT DISTINCT r, kind, place FROM windows WHERE p = 0 OR p + 16 <= n_units - 4),
entries AS (SELECT c.r, c.kind, c.place, g.hash FROM chosen c JOIN grams g ON g.r = c.r AND g.kind = c.kind AND g.p = c.place),
prints AS (
    SELECT r, kind, string_agg(place || ':' || lower(lpad(to_hex(hash), 15, '0')), ' ' ORDER BY place) AS print, list_distinct(list(hash)) AS hashes
    FROM entries GROUP BY r, kind
),
whole AS (
    SELECT t.r, t.kind, t.text, coalesce(p.print, '') AS print, coalesce(p.hashes, []) AS hashes FROM texts t LEFT JOIN prints p ON t.r = p.r AND t.kind = p.kind
)
SELECT b.doc_id, CAST(length(b.text) AS BIGINT) AS n_chars, sha256(e.text) AS edited_sha256, o.print AS fingerprint, e.print AS edited_fingerprint,
    coalesce(len(list_intersect(o.hashes, e.hashes))::DOUBLE / nullif(len(list_distinct(o.hashes || e.hashes)), 0), 1) AS near_edited,
    coalesce(len(list_intersect(o.hashes, x.hashes))::DOUBLE / nullif(len(list_distinct(o.hashes || x.hashes)), 0), 1) AS near_next
FROM beside b JOIN whole o ON o.r = b.r AND o.kind = 0 JOIN whole e ON e.r = b.r AND e.kind = 1 JOIN whole x ON x.r = b.next_r AND x.kind = 0
"""
).format(unit=winnowing.UNIT)

OP13_SQL = r"""
WITH ordered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS position,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, count(*) AS own, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
        lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))) % 4 AS h
    FROM ordered GROUP BY conv_id
),
steps AS (
    SELECT c.conv_id, o.position + 1 AS depth, role, text FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.position < c.h
    UNION ALL
    SELECT c.conv_id, o.position - c.h + least(c.h, coalesce(b.own, 0)) + 1, role, text
    FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.position >= c.h LEFT JOIN convs b ON b.conv_id = c.base
),
paths AS (
    SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, count(*) OVER (PARTITION BY conv_id) AS length,
        string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS key
    FROM steps
    UNION ALL
    SELECT conv_id, 0, 0, (SELECT count(*) FROM steps s WHERE s.conv_id = c.conv_id), '' FROM convs c
),
nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
        string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length) AS ends
    FROM paths GROUP BY key, depth
),
parents AS (SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
grown AS (SELECT n.*, coalesce(p.n_children, 0) AS n_children FROM nodes n LEFT JOIN parents p USING (key)),
subtrees AS (
    SELECT left(g.key, 32 * t.d) AS key, sum(saved) AS saved_tokens, sum((n_children = 0)::INT) AS n_leaves
    FROM grown g, unnest(range(g.depth + 1)) AS t(d) GROUP BY 1
)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
    CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(g.ends, '')) AS ends_sha256
FROM grown g JOIN subtrees s USING (key) LEFT JOIN nodes p ON g.depth > 0 AND p.key = left(g.key, 32 * (g.depth - 1))
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_wrapper_text, op2_unit_dedup, op3_quality_ledger, op4_impact_topk, op5_license_rules, op6_subword_quality,
        op7_simhash_ring, op8_gru_score, op9_byte_bpe, op10_source_mix,
        op11_winnowing, op12_block_whitening, op13_prefix_trie,
    )
}
ORACLES = {"op3_quality_ledger": OP3_SQL, "op4_impact_topk": OP4_SQL, "op10_source_mix": OP10_SQL, "op11_winnowing": OP11_SQL, "op13_prefix_trie": OP13_SQL}
