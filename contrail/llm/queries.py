"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.chunk_dedup import exact_duplicates
from contrail.llm.common import table
from contrail.llm.decontaminate import contamination
from contrail.llm.lexicon_bpe import encoding_digests
from contrail.llm.line_dedup import line_duplicates
from contrail.llm.minhash import near_duplicates
from contrail.llm.packing import pack
from contrail.llm.pii import personal_spans
from contrail.llm.source_audit import source_divergence
from contrail.llm.substring import remove_repeats
from contrail.llm.token_scan import token_file_scan
from contrail.llm.toxicity import toxicity
from contrail.llm.training_order import training_order
from contrail.llm.whitening import whiten


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_duplicates(table(spark, sf_dir, "documents"), short=True)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(table(spark, sf_dir, "documents")).drop("span_list", "row_hash")


def op8_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_training_order": op4_training_order,
    "op5_minhash": op5_minhash,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_pii": op7_pii,
    "op8_token_scan": op8_token_scan,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_lexicon_bpe": op12_lexicon_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
        FROM d JOIN g ON d.body = g.body
    """,
    "op5_minhash": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS ws FROM documents
        ),
        starts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS s FROM d WHERE len(ws) > 0),
        sets AS (SELECT DISTINCT doc_id, array_to_string(ws[s:s + 1], ' ') AS w FROM starts),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.w = b.w AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
          SELECT x, y FROM common JOIN sizes m ON m.doc_id = x JOIN sizes n ON n.doc_id = y WHERE 100 * c >= 80 * (m.n + n.n - c)
        ),
        reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
        least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(coalesce(y, d.doc_id), d.doc_id) AS component_id,
          least(coalesce(y, d.doc_id), d.doc_id) = d.doc_id AS kept
        FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON x = d.doc_id
    """,
    "op6_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d),
        windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS w FROM starts),
        marked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1 AS repeated FROM windows),
        hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM marked WHERE repeated),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
        kept AS (
          SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS body, count(*) AS n
          FROM words w LEFT JOIN hit h ON h.doc_id = w.doc_id AND h.p = w.p WHERE h.p IS NULL GROUP BY w.doc_id
        )
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
          sha256(coalesce(k.body, '')) AS kept_sha256
        FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id
    """,
    "op9_decontamination": r"""
        WITH source AS (
          SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
          UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark
        ),
        split AS (
          SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM source
        ),
        items AS (
          SELECT id, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s
          FROM split WHERE kind = 'b' AND len(ws) > 0
        ),
        keys AS (SELECT DISTINCT id AS item_id, size, array_to_string(ws[s:s + size - 1], ' ') AS w FROM items),
        sizes AS (SELECT DISTINCT size FROM keys),
        places AS (
          SELECT d.id, d.ws, z.size, unnest(range(1, len(d.ws) - z.size + 2)) AS s
          FROM split d, sizes z WHERE d.kind = 'd' AND len(d.ws) >= z.size
        ),
        found AS (
          SELECT p.id, p.s, p.size, k.item_id
          FROM places p JOIN keys k ON k.size = p.size AND k.w = array_to_string(p.ws[p.s:p.s + p.size - 1], ' ')
        ),
        hits AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(s, s + size)) AS q FROM found) x GROUP BY id),
        named AS (
          SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list
          FROM (SELECT DISTINCT id, item_id FROM found) x GROUP BY id
        )
        SELECT CAST(d.id AS BIGINT) AS doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
          coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.list, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
        FROM split d LEFT JOIN hits h ON h.id = d.id LEFT JOIN named n ON n.id = d.id WHERE d.kind = 'd'
    """,
    "op13_source_divergence": r"""
        WITH d AS (
          SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
          FROM documents
        ),
        own AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term FROM own GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
        counts AS (SELECT lang, source, term, count(*) AS n FROM own JOIN kept USING (lang, term) GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source FROM d),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        sizes AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
        whole AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM counts GROUP BY lang, term),
        p AS (
          SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
            1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (coalesce(s.total, 0) + 5 * v.v) AS p
          FROM groups g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
          LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
          LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ),
        apart AS (
          SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        pairs AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        ),
        terms AS (
          SELECT p.lang, p.source, 'term' AS part, p.term AS item,
            p.p - (1 + (1000000000 * (w.n + 5)::HUGEINT) // (w.total + 5 * v.v)) AS value
          FROM p JOIN whole w ON w.lang = p.lang AND w.term = p.term JOIN v ON v.lang = p.lang WHERE p.n > 0
        ),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
          FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms WHERE value > 0) x
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
}
