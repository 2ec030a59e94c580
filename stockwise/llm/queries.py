"""Registered queries of the training-data operators, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwise.llm.common import documents
from stockwise.llm import chat_format, code_compression, license_scan
from stockwise.llm.fingerprints import fingerprint_documents
from stockwise.llm.ngram_join import near_duplicates
from stockwise.llm.packing import pack
from stockwise.llm.phrase_automata import remove_repeated_windows
from stockwise.llm.pii import replace_pii
from stockwise.llm.quality_rules import quality_rules
from stockwise.llm.sentencepiece_codec import encode
from stockwise.llm.spelling_variants import spelling_variants, word_counts
from stockwise.llm.suffix_dedup import remove_repeats
from stockwise.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return deco


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query(oracle=license_scan.oracle())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


@query(oracle=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
           THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id
FROM n JOIN (SELECT a, min(b) AS c FROM r GROUP BY 1) m ON m.a = n.doc_id
""")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query()
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), 400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), labels(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), digest=True)


@query(oracle=chat_format.ORACLE)
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_chats(chat_format.records(rows.unionByName(more))))


@query()
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


SURROGATE_KEY = "corpus-surrogates-1"     # a run's secret in production


@query()
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)


@query()
def op9_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@query()
def op10_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 2048, added=True)


@query(oracle=code_compression.oracle())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_compression.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return code_compression.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(code_compression.digest(books)).alias("codebooks_sha256"))


@query(oracle=r"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_concat([i], range(8)::BIGINT[]), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS crc FROM range(256) AS r(i)),
u AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS x FROM documents),
r AS (SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x, count(*) AS m FROM u GROUP BY ALL),
y AS (SELECT x, m, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || x)) AS b FROM r WHERE length(x) >= 6),
h AS (SELECT x, m, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(b), 2), lambda i: ('0x' || b[i:i + 1])::BIGINT)),
        lambda c, k: xor(c // 256, crc[xor(c % 256, k) + 1])), 4294967295::BIGINT) AS h FROM y, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN left(x, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word, m FROM h),
v AS (SELECT word, sum(m)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY 1 HAVING sum(m) >= 5),
c AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM c a JOIN c b
        ON a.i = b.i AND length(a.word) = length(b.word) AND left(a.word, a.i) = left(b.word, b.i) AND substr(a.word, a.i + 2) = substr(b.word, b.i + 2) AND a.word <> b.word),
e AS (SELECT DISTINCT c.word AS longer, c.n AS longer_n, v.word AS shorter, v.n AS shorter_n FROM c JOIN v ON left(c.word, c.i) || substr(c.word, c.i + 2) = v.word),
a AS (SELECT * FROM p UNION ALL SELECT longer, shorter, shorter_n FROM e UNION ALL SELECT shorter, longer, longer_n FROM e),
f AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM a GROUP BY 1),
g AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
        CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN f USING (word)),
z(word, root) AS (SELECT word, word FROM g UNION ALL SELECT z.word, g.form FROM z JOIN g ON g.word = z.root WHERE g.form IS NOT NULL)
SELECT g.word, g.form, z.root, g.n, g.n_near, g.form_n
FROM g JOIN z USING (word) JOIN g AS top ON top.word = z.root WHERE top.form IS NULL
""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(documents(spark, sf_dir)))


@query(oracle=r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
v AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d),
g AS (SELECT doc_id, s, row_number() OVER (PARTITION BY ws[s:s + 19] ORDER BY doc_id, s) AS k FROM v),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM g WHERE k > 1),
w AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM d),
j AS (SELECT w.doc_id, string_agg(CASE WHEN r.i IS NULL THEN x END, ' ' ORDER BY w.i) AS t, count(r.i) AS gone
      FROM w LEFT JOIN r USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256,
       coalesce(spans, 0)::BIGINT AS n_spans
FROM d LEFT JOIN j USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS spans FROM r
  WHERE NOT EXISTS (SELECT 1 FROM r AS p WHERE p.doc_id = r.doc_id AND p.i = r.i - 1) GROUP BY 1) USING (doc_id)
""")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_windows(documents(spark, sf_dir), 20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "n_spans")
