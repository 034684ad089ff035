"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chatfmt, decontam, lexsearch, licensescan, mixing, neardup, qualityforest, radixdedup, records, sentencespans, sourceaudit, toxicity, urlrules
from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents")).drop("copies")


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_table(table(spark, sf_dir, "documents"), tokenizer_path()).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chatfmt.read_back(chatfmt.format_chats(chatfmt.conversation_records(rows), mappings=chatfmt.AS_THEY_STAND))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("mined")


def op7_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityforest.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencespans.deduplicate_spans(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_sentences", "n_removed", "n_removed_chars", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_radix_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radixdedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sourceaudit.audit_sources(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licensescan.scan_licenses(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_mix_sources, op2_token_records, op3_toxicity, op4_minhash_near_dedup, op5_chat_format, op6_url_rules, op7_quality_forest, op8_sentence_spans, op9_bm25_decontamination, op10_radix_substrings, op11_source_audit, op12_license_scan, op13_lexical_search)
    return {f.__name__: f for f in own} | {"pipeline": pipeline}


_WORDS = r"[^\x20\x09-\x0D]+"

MIX_SQL = rf"""
WITH sized AS (SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h, CAST(coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS t FROM sized GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][t % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM per),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER above, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER above, 0)) AS level
      FROM w WINDOW above AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap
      ELSE weight * first_value(CASE WHEN cap > level * weight THEN level END IGNORE NULLS) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target FROM l),
r AS (SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
      CAST('0x' || substr(h, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

NEAR_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, w.doc_id = m.c AS kept FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT a, min(b) AS c FROM r GROUP BY 1) m ON m.a = w.doc_id
"""

CHAT_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) + 24 AS chars FROM t),
g AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS every,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars FROM e GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, sha256(every) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

RADIX_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS MATERIALIZED (SELECT rid, p, md5(substr(hx, 2 * p + 1, 400)) AS h FROM (SELECT rid, hx, unnest(generate_series(0, length(hx) // 2 - 200)) AS p FROM d WHERE length(hx) >= 400)),
s AS MATERIALIZED (SELECT rid, p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
o AS (SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + 200 THEN 0 ELSE 1 END AS fresh FROM s),
i AS (SELECT rid, min(p) AS a, max(p) + 200 AS b FROM (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS g FROM o) GROUP BY rid, g),
k AS (SELECT i.rid, count(*) AS n, sum(b - a) AS gone, string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS pieces, max(b) AS last
      FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM i) i JOIN d ON d.rid = i.rid GROUP BY 1)
SELECT doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(pieces || substr(hx, 2 * last + 1), hx))) AS kept_sha256 FROM d LEFT JOIN k ON k.rid = d.rid
"""

AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (n.n + 5 * v.v) AS p
      FROM n JOIN k ON k.lang = n.lang JOIN v ON v.lang = n.lang LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
lc AS (SELECT k.lang, k.term, sum(c.c) AS c FROM k JOIN c ON c.lang = k.lang AND c.term = k.term GROUP BY 1, 2),
q AS (SELECT lc.lang, lc.term, 1 + (1000000000::HUGEINT * (lc.c + 5)) // (t.n + 5 * v.v) AS q FROM lc JOIN v ON v.lang = lc.lang JOIN (SELECT lang, sum(c) AS n FROM lc GROUP BY 1) t ON t.lang = lc.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT y.lang, y.source, z.source AS item, sum(abs(y.p - z.p)) AS value FROM p y JOIN p z ON y.lang = z.lang AND y.term = z.term AND y.source <> z.source GROUP BY 1, 2, 3) x
          ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p.p > q.q),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) WHERE part = 'pair' OR rank <= 50
"""

SEARCH_SQL = r"""
WITH i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS ts FROM documents),
a AS (SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT n FROM a) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t GROUP BY 1),
m AS (SELECT rid, doc_id, 100 - 50 + (50 * len(ts) * a.n) // a.l AS m FROM d, a WHERE len(ts) > 0),
s AS (SELECT i.item_id, m.rid, m.doc_id, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * m.m)))::BIGINT AS score
      FROM i JOIN t ON t.term = i.term JOIN w ON w.term = i.term JOIN m ON m.rid = t.rid GROUP BY 1, 2, 3)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    """For the others SQL lacks the tokenizer, the models or the index; tests/llm holds them against brute force, round trips or held-out labels."""
    return {"op1_mix_sources": MIX_SQL, "op4_minhash_near_dedup": NEAR_SQL, "op5_chat_format": CHAT_SQL, "op10_radix_substrings": RADIX_SQL, "op11_source_audit": AUDIT_SQL, "op13_lexical_search": SEARCH_SQL}
