"""Registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (op1_licenses, op2_near_duplicates, op3_warc, op4_bpe, op5_fingerprint, op7_packing,
                            op8_quality, op9_pii, op10_language, op11_repeats, op12_infill, op13_prefix_trie)
from panelspark.llm import op6_token_rows as op6_rows
from panelspark.llm.common import documents


def rank_file() -> tuple[str, str]:
    """Vocabulary file and pattern of the production tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = op1_licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    hits = hits.select("doc_id", op1_licenses.best_of(F.col("licences")).alias("best"), F.size("licences").cast("bigint").alias("n_units"))
    return hits.select("doc_id", F.col("best.licence").alias("licence"), F.col("best.score").alias("score"), "n_units")


def op2_near_duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_near_duplicates.classes(documents(spark, sf_dir)).select("doc_id", "class_id")


def op3_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_warc.archive_round_trip(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_bpe.round_trip(documents(spark, sf_dir), *rank_file())


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_fingerprint.fingerprint_edits(documents(spark, sf_dir))


def op6_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_rows.pack_rows(documents(spark, sf_dir), *rank_file())


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_packing.pack(op7_packing.with_clusters(documents(spark, sf_dir)), F.col("words"), F.col("cluster"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op8_quality.ledger(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "ledger.*")
    base = op8_quality.mask_of("v1")
    return rows.withColumn("base_failed", F.col("failure_bits").bitwiseAND(F.lit(base)) != 0) \
        .withColumn("kept", op8_quality.verdict(F.col("failure_bits")))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pii.report(documents(spark, sf_dir))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = op10_language.fit(docs)
    return op10_language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (~op10_language.may_learn(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op11_repeats.remove_repeats(documents(spark, sf_dir))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, span: n + span["end"] - span["start"])
    return rows.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op12_infill.restore(op12_infill.transform(documents(spark, sf_dir)))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_prefix_trie.family_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_near_duplicate_classes, op3_warc_capture_index, op4_bpe_round_trip, op5_order_minhash, op6_token_rows,
    op7_best_fit_packing, op8_quality_rules, op9_personal_data, op10_language_crf, op11_repeated_passages, op12_fill_in_middle,
    op13_conversation_trie)}


def _quality_sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {op8_quality.BIT[name]} ELSE 0 END" for name, rule in op8_quality.RULES)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY doc_id, k) >= 2),
c AS (SELECT doc_id, sum(least(5, coalesce(later - i, 5))) AS n
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM r) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g'))::BIGINT AS n_upper
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id),
b AS (SELECT *, ({bits})::BIGINT AS failure_bits FROM m)
SELECT *, (failure_bits & {op8_quality.mask_of('v1')}) <> 0 AS base_failed,
  (failure_bits & {op8_quality.mask_of(op8_quality.PRODUCTION)}) = 0 AS kept FROM b"""


def _license_sql() -> str:
    t, ratio = op1_licenses.THRESHOLD, op1_licenses.THRESHOLD / (2 - op1_licenses.THRESHOLD)
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in op1_licenses.template_bigrams(text)))
                     for name, text in sorted(op1_licenses.TEMPLATES.items()))
    return rf"""
WITH templates(name, tg) AS (VALUES {rows}),
u AS (SELECT doc_id, row_number() OVER () AS unit, x
      FROM (SELECT doc_id, unnest(list_append(string_split(text, chr(10)), text)) AS x FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, unit, list_filter(string_split(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda y: y <> '') AS w FROM u),
g AS (SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) >= 2),
s AS (SELECT doc_id, unit, name, 2.0::DOUBLE * len(list_intersect(g, tg)) / (len(g) + len(tg)) AS score
      FROM g JOIN templates ON len(g) >= len(tg) * {ratio} AND len(g) * {ratio} <= len(tg)),
h AS (SELECT doc_id, unit, name, score FROM s WHERE score >= {t} QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, name) = 1),
best AS (SELECT doc_id, name, score, count(*) OVER (PARTITION BY doc_id) AS n FROM h
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name) = 1)
SELECT d.doc_id, best.name AS licence, best.score AS score, coalesce(best.n, 0)::BIGINT AS n_units
FROM documents d LEFT JOIN best ON d.doc_id = best.doc_id"""


REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
r AS (SELECT doc_id, i FROM s JOIN (SELECT k, min(doc_id) AS least FROM s GROUP BY k) USING (k) WHERE least < doc_id),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM r, (SELECT unnest(range(0, 13)) AS j)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM x ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id) g ON d.doc_id = g.doc_id"""

INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
        ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
c AS (SELECT *, len(u)::BIGINT AS n, (least(h1 % (len(u) + 1), h2 % (len(u) + 1)))::BIGINT AS a,
        (greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)))::BIGINT AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

#: Node keys are the joined digests of the turns; sums over subtrees go to every prefix of a key.
TRIE_SQL = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, s, bit, v) AS (
  SELECT conv_id, conv_id::VARCHAR, 0, xor(4294967295::BIGINT, ascii(conv_id::VARCHAR)::BIGINT) FROM ids
  UNION ALL
  SELECT conv_id, s, bit + 1, xor(CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END,
    CASE WHEN (bit + 1) % 8 = 0 AND (bit + 1) // 8 < length(s) THEN ascii(s[(bit + 1) // 8 + 1])::BIGINT ELSE 0::BIGINT END)
  FROM crc WHERE bit < 8 * length(s)),
h AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(v, 4294967295::BIGINT) % 6 AS h FROM crc WHERE bit = 8 * length(s)),
raw AS (SELECT conv_id, turn, coalesce(text, '') AS text,
          md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS dg FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dg) AS pos FROM raw),
reb AS (SELECT h.conv_id, 0 AS part, pos, dg, text FROM h JOIN o ON o.conv_id = h.base AND pos <= h
        UNION ALL SELECT h.conv_id, 1, pos, dg, text FROM h JOIN o ON o.conv_id = h.conv_id AND pos > h),
seq AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(dg, '') OVER w AS k, length(text) AS chars FROM reb
        WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
m AS (SELECT * FROM seq UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
n AS (SELECT k, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY k),
kids AS (SELECT left(k, length(k) - 32) AS k, count(*) AS n_children FROM n WHERE k <> '' GROUP BY 1),
sub AS (SELECT left(n.k, 32 * d) AS k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM n) n LEFT JOIN kids ON kids.k = n.k GROUP BY 1),
ends AS (SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
         FROM (SELECT conv_id, max_by(k, depth) AS k FROM m GROUP BY conv_id) GROUP BY k)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n LEFT JOIN n up ON n.k <> '' AND up.k = left(n.k, length(n.k) - 32) LEFT JOIN kids ON kids.k = n.k
  JOIN sub ON sub.k = n.k LEFT JOIN ends ON ends.k = n.k"""

ORACLE = {"op11_repeated_passages": REPEATS_SQL, "op12_fill_in_middle": INFILL_SQL, "op13_conversation_trie": TRIE_SQL,
          "op8_quality_rules": _quality_sql(), "op1_license_scan": _license_sql()}
