"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import byte_bpe, chat, collision_search, html_wrappers, merkle, ngram_join, packing, quality_rules, ranked_search, token_counts, token_files, toxicity, warc
from tracewell.llm.common import saved, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")  # no id, no label, no fold
    return toxicity.scored(docs, model).select("doc_id", held_out, "score", "predicted")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ngram_join.links(table(spark, sf_dir, "documents"), size=4, percent=85)
    return rows.drop("class")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, sf_dir, "pages")))
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    page_id, refers_to = number("record_id").try_cast("bigint"), number("refers_to").try_cast("bigint")
    return records.select(page_id.alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), refers_to.alias("refers_to"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.formatted(turns), in_order=True)


def op6_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extracted(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = saved(quality_rules.statistics(table(spark, sf_dir, "documents")), "quality-statistics")
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"))
    return quality_rules.judged(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, sf_dir, "documents")), "bigint")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    altered = {"text": F.translate("text", capitals, capitals.lower())}
    leaves = merkle.leaves(table(spark, sf_dir, "documents"), "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], tampered, altered)
    rows = merkle.manifest(leaves).withColumnRenamed("key", "doc_id")
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), vocabulary="byte_bpe_50k.json", limit=1024)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_ngram_join": op2_ngram_join,
        "op3_warc": op3_warc,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_chat": op5_chat,
        "op6_collision_search": op6_collision_search,
        "op7_html_wrappers": op7_html_wrappers,
        "op8_quality_rules": op8_quality_rules,
        "op9_token_files": op9_token_files,
        "op10_packing": op10_packing,
        "op11_merkle": op11_merkle,
        "op12_ranked_search": op12_ranked_search,
        "op13_token_counts": op13_token_counts,
    }


JOIN_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, len(s) AS n FROM g), e AS (SELECT doc_id, unnest(s) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 85 * (na.n + nb.n - o)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM u GROUP BY a)
SELECT n.doc_id, n AS n_shingles, min(c) AS component_id, coalesce(n_links, 0) AS n_links FROM n JOIN r USING (doc_id) LEFT JOIN k USING (doc_id) GROUP BY ALL"""

WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to FROM d"""

_STARTS = ["\\", "### System:", "### User:", "### Assistant:", "### Role <", ">:", "</turn>"]
_ESCAPES = " + ".join(f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in _STARTS)
CHAT_SQL = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER w AS k, lag(role, 1, '') OVER w AS prev, length(text) + {_ESCAPES} + length(CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' ELSE '### Assistant: ' END) + 9 AS chars FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (SELECT *, CASE WHEN (prev, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) THEN NULL ELSE role || ' after ' || CASE prev WHEN '' THEN 'the start' ELSE prev END END AS bad FROM n),
c AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256, coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '') AS said, CAST(sum(chars) AS BIGINT) AS formatted_chars, arg_min(bad, k) AS fault, arg_max(role, k) AS ended FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(said) AS loss_chars, sha256(said) AS loss_sha256, formatted_chars, coalesce(fault, CASE WHEN ended <> 'assistant' THEN 'the end after ' || ended END) IS NULL AS valid, coalesce(fault, CASE WHEN ended <> 'assistant' THEN 'the end after ' || ended END) AS fault FROM c"""

_CRC = "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT), lambda c, d: list_reduce(range(8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, d)), 4294967295), 4294967295)"
MERKLE_SQL = f"""WITH RECURSIVE f AS (SELECT doc_id, lang, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other FROM (SELECT *, {_CRC} AS crc FROM documents)),
leaf AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h, sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS o FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaf),
t(lang, lvl, pos, h) AS (SELECT lang, 0, pos, h FROM p UNION ALL
 SELECT lang, any_value(lvl) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS c FROM t) WHERE c > 1 GROUP BY lang, pos // 8),
s AS (SELECT lang, max(lvl) AS top, arg_max(h, lvl) AS subroot FROM t GROUP BY lang),
g(lang, lvl, pos, h) AS (SELECT NULL::VARCHAR, 0, row_number() OVER (ORDER BY lang NULLS FIRST) - 1, subroot FROM s UNION ALL
 SELECT NULL, any_value(lvl) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS c FROM g) WHERE c > 1 GROUP BY pos // 8),
r AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS height FROM g),
w AS (SELECT p.doc_id, p.h, p.o, p.lang, p.pos, s.top, s.subroot, row_number() OVER () AS id, g.pos AS at FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang JOIN g ON g.lvl = 0 AND g.h = s.subroot),
x AS (SELECT w.id, t.lvl, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < (w.pos >> (3 * t.lvl))), '') AS a, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > (w.pos >> (3 * t.lvl))), '') AS b
 FROM w JOIN t ON w.lang IS NOT DISTINCT FROM t.lang AND t.lvl < w.top AND t.pos // 8 = (w.pos >> (3 * t.lvl + 3)) GROUP BY w.id, t.lvl
 UNION ALL SELECT w.id, w.top + g.lvl, coalesce(string_agg(g.h, '' ORDER BY g.pos) FILTER (g.pos < (w.at >> (3 * g.lvl))), ''), coalesce(string_agg(g.h, '' ORDER BY g.pos) FILTER (g.pos > (w.at >> (3 * g.lvl))), '')
 FROM w JOIN r ON true JOIN g ON g.lvl < r.height AND g.pos // 8 = (w.at >> (3 * g.lvl + 3)) GROUP BY w.id, w.top, g.lvl),
q AS (SELECT id, string_agg(a || b, '' ORDER BY lvl) AS sibs FROM x GROUP BY id),
z(id, lvl, h) AS (SELECT id, 0, o FROM w UNION ALL SELECT z.id, z.lvl + 1, sha256(a || z.h || b) FROM z JOIN x ON x.id = z.id AND x.lvl = z.lvl),
e AS (SELECT id, arg_max(h, lvl) AS folded FROM z GROUP BY id)
SELECT doc_id, h AS leaf, subroot, root, sha256(coalesce(sibs, '')) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM w CROSS JOIN r LEFT JOIN q USING (id) JOIN e USING (id)"""

RANKED_SQL = r"""WITH d AS (SELECT doc_id, row_number() OVER () AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
i AS (SELECT item_id, k, t, count(*) AS q FROM (SELECT item_id, row_number() OVER () AS k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
n AS (SELECT id, any_value(doc_id) AS doc_id, count(*) AS n FROM d GROUP BY id), c AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM n),
f AS (SELECT id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM i) GROUP BY ALL), v AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f CROSS JOIN c GROUP BY t, nn),
s AS (SELECT item_id, k, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l))))::BIGINT AS score FROM i JOIN f USING (t) JOIN v USING (t) JOIN n USING (id) CROSS JOIN c GROUP BY item_id, k, id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 20"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are held against brute force in tests."""
    return {"op2_ngram_join": JOIN_SQL, "op3_warc": WARC_SQL, "op5_chat": CHAT_SQL, "op11_merkle": MERKLE_SQL, "op12_ranked_search": RANKED_SQL}
