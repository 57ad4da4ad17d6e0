"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, exact_dedup, jaccard, lm, neighbours, packing, pii, resampling, sentencepiece_bpe, sharding, token_counts, toxicity, warc
from ._spark import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), kinds="kinds")
    return out.select("doc_id", "text", F.size("kinds").alias("n_entities"), "kinds")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).drop("source")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(spark, warc.write_records(table(spark, sf_dir, "pages"), min_bytes=0)).drop("url")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encoded(table(spark, sf_dir, "documents"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(turns), ids=turns)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    all_of_them = (
        op1_toxicity, op2_jaccard_join, op3_pii, op4_exact_dedup, op5_lm, op6_sharding, op7_packing, op8_neighbours, op9_warc, op10_sentencepiece,
        op11_conversations, op12_resampling, op13_token_counts,
    )
    return {f.__name__: f for f in all_of_them}


# A-Z and a-z, and the digits of base32 (RFC 4648).
_UPPER, _LOWER, _BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


# CRC-32: a table row `t` of 256 steps, made by the rule, and the value of a list of bytes.
_CRC_TABLE = """tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    code = f"hex(encode({text}))"
    data = f"list_transform(range(0, len({code}), 2), lambda i: CAST('0x' || substr({code}, CAST(i + 1 AS INTEGER), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


def oracle_sql() -> dict[str, str]:
    # five hexadecimal digits at a time are four of base32
    digits = " || ".join(f"substr('{_BASE32}', CAST(((CAST('0x' || substr(h, {k + 1}, 5) AS BIGINT) >> {b}) & 31) AS INTEGER) + 1, 1)" for k in range(0, 40, 5) for b in (15, 10, 5, 0))
    return {
        "op2_jaccard_join": rf"""
            WITH RECURSIVE t AS (SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents),
            g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM t),
            s AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM g),
            l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
            r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON r.doc_id = l.a)
            SELECT doc_id, any_value(n) AS n_shingles, min(root) AS component_id, any_value(links) AS n_links
            FROM r JOIN (SELECT doc_id, len(g) AS n, (SELECT count(*) FROM l WHERE l.a = g.doc_id) AS links FROM g) USING (doc_id) GROUP BY doc_id""",
        "op4_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
        "op11_conversations": rf"""
            WITH RECURSIVE {_CRC_TABLE},
            k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
            d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32('key')} % 20 AS fault FROM k, tab),
            m AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d),
            p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM m),
            s AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS nth, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM p),
            f AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM s),
            edit(a, b, initial, letter, cost, role) AS (VALUES (0, 0, '', 'D', 3, ''), (1, 1, '', 'D', 3, ''), (2, 2, '', 'D', 3, ''), (3, 3, '', 'D', 3, ''), (0, 1, 's', 'K', 0, ''), (0, 2, 'u', 'K', 0, ''), (1, 2, 'u', 'K', 0, ''),
                (3, 2, 'u', 'K', 0, ''), (2, 3, 'a', 'K', 0, ''), (0, 2, '', 'R', 2, 'user'), (1, 2, '', 'R', 2, 'user'), (3, 2, '', 'R', 2, 'user'), (2, 3, '', 'R', 2, 'assistant')),
            put(a, b, letters, cost, made) AS (SELECT x, x, '', 0, '' FROM range(4) r(x) UNION ALL VALUES (0, 2, 'I', 2, chr(10) || 'user:'), (1, 2, 'I', 2, chr(10) || 'user:'), (3, 2, 'I', 2, chr(10) || 'user:'), (2, 3, 'I', 2, chr(10) || 'assistant:'),
                (0, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:')),
            r AS (
                SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, CAST(put.b AS BIGINT) AS s, {{'cost': CAST(cost AS BIGINT), 'audit': letters, 'made': made}} AS best FROM conversations, put WHERE put.a = 0
                UNION ALL
                SELECT r.conv_id, r.n + 1, CAST(put.b AS BIGINT), min({{'cost': r.best.cost + edit.cost + put.cost + CASE WHEN letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END, 'audit': r.best.audit || letter || letters,
                    'made': r.best.made || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || edit.role || ':' || f.text END || put.made}})
                FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.n = r.n + 1 JOIN edit ON edit.a = r.s AND (letter <> 'K' OR edit.initial = f.initial) AND (letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) JOIN put ON put.a = edit.b
                GROUP BY r.conv_id, r.n, put.b),
            c AS (SELECT c.conv_id, count(f.n) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps, count(*) FILTER (f.fault = 'blank') AS blank, count(*) FILTER (f.fault = 'duplicate') AS duplicate,
                    count(*) FILTER (f.fault = 'truncated') AS truncated, count(*) FILTER (before || f.initial NOT IN ('su', 'ua', 'au')) AS illegal
                  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id)
            SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, min(best).cost AS cost, min(best).audit AS audit, sha256(substr(min(best).made, 2)) AS repaired_sha256
            FROM c JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.n = c.n AND r.s IN (0, 3) GROUP BY ALL""",
        "op12_resampling": rf"""
            WITH {_CRC_TABLE},
            w AS (SELECT 'd' AS part, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
                  UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
            f AS (SELECT part, id, x, count(*) AS n FROM (SELECT part, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS x FROM w) GROUP BY ALL),
            h AS (SELECT x, {_crc32('x')} % 10000 AS bucket FROM (SELECT DISTINCT x FROM f), tab),
            s AS (SELECT bucket, sum(n) FILTER (part = 'd') AS s, sum(n) FILTER (part = 'b') AS t FROM f JOIN h USING (x) GROUP BY bucket),
            g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000) / ((s + 1) * (coalesce((SELECT sum(t) FROM s), 0) + 10000)))) AS BIGINT) AS gain FROM s WHERE s > 0),
            e AS (SELECT id, sum(n) AS n, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight FROM f JOIN h USING (x) JOIN g USING (bucket) WHERE part = 'd' GROUP BY id),
            o AS (SELECT doc_id, len(w) AS words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
                  FROM (SELECT id AS doc_id, w FROM w WHERE part = 'd') LEFT JOIN e ON id = doc_id),
            p AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS nth FROM o WHERE words >= 20)
            SELECT doc_id, n_features, weight, score, CASE WHEN nth <= 25 * (SELECT count(*) FROM p) // 100 THEN nth END AS rank FROM o LEFT JOIN p USING (doc_id)""",
        "op9_warc": f"""
            WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
            SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {digits} AS payload_digest,
                   CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM p""",
    }
