"""The ``opN_<name>`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm import (
    decontaminate,
    language_id,
    line_dedup,
    lm_scoring,
    packing,
    piece_codec,
    prefix_trie,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    vector_dedup,
    warc,
)
from barframe.llm.words import BATCH_ROWS
from barframe.plans.workspace import scratch_path

SHARDS = 24
HEAD_TURNS = 4


def model_path(name: str = "piece_bpe_32k.model", variable: str = "PIECE_MODEL") -> str:
    """A tokenizer's file; an environment variable overrides the installed one."""
    if variable in os.environ:
        return os.environ[variable]
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_codec.encode_digests(docs, model_path()).drop("text")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType.simpleString()
    as_id = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(kind)
    return warc.read_archives(spark, folder).select(
        as_id("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_words", "n_covered", "coverage", F.size("tiles").alias("n_tiles")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"), kept="sha256").withColumnRenamed("kept", "kept_sha256")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * SHARDS)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _fold("doc_id", 3) == 1
    net = language_id.fit(docs.where(~held_out), "doc_id", "text", "lang")
    return language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), net).drop("text")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _fold("doc_id", 5) == 1
    model = lm_scoring.train(docs, "text", ~held_out, {"doc_id": F.col("doc_id"), "held_out": held_out})
    return lm_scoring.score_own(spark, model)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(_table(spark, sf_dir, "documents"), "doc_id", "text", drop=True)
    return spelling.spelling_forms(words)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_digests(_table(spark, sf_dir, "conversations"))
    rebuilt = prefix_trie.splice_heads(turns, F.col("conv_id") - F.col("conv_id") % 20, _fold("conv_id", HEAD_TURNS), HEAD_TURNS)
    return prefix_trie.prefix_trie(rebuilt, turns.select("conv_id").distinct())


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, model_path("word_bpe_49k.json", "WORD_MODEL")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def _crc32_sql(text: str) -> str:
    """CRC-32 of a SQL expression's UTF-8 bytes, bit by bit, the lowest first; DuckDB has no such function."""
    byte = f"CAST('0x' || substr(hex({text}), 2 * (i // 8) + 1, 2) AS UBIGINT)"
    bits = f"list_transform(range(0, 8 * strlen({text})), lambda i: ({byte} >> (i % 8)) & 1)"
    step = "xor(a >> 1, 3988292384 * (xor(a, b) & 1))"
    return f"xor(list_reduce({bits}, lambda a, b: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_line_dedup, op3_warc, op4_decontamination, op5_simhash, op6_embedding_dedup,
        op7_substring_dedup, op8_sharding, op9_language_id, op10_lm_scoring, op11_spelling, op12_prefix_trie, op13_packing,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": rf"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
b AS (SELECT key, min((doc_id, pos)) AS first FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
f AS (SELECT k.*, b.key IS NOT NULL AND (k.doc_id, k.pos) <> b.first AS gone FROM k LEFT JOIN b USING (key)),
d AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept FROM f GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_removed_lines, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN d USING (doc_id)""",
    "op3_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN size >= {warc.MIN_REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
    "op11_spelling": rf"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS raw FROM documents WHERE text IS NOT NULL),
l AS (SELECT translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, doc_id || ':' || run AS tag FROM r),
h AS (SELECT run, {_crc32_sql("tag")} AS h FROM l),
c AS (SELECT CASE WHEN h % {spelling.DROP_ONE_IN} = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM h),
w AS (SELECT word, count(*) AS n FROM c WHERE length(word) >= {spelling.MIN_LETTERS} GROUP BY word HAVING count(*) >= {spelling.MIN_COUNT}),
k AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM w),
d AS (SELECT word, n, left(word, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest, i FROM k),
p AS (SELECT a.word, b.word AS other, b.n FROM d a JOIN d b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.rest = b.word),
f AS (SELECT word, count(*) AS n_near, max(p.n) AS top, min(struct_pack(o := -p.n, w := p.other)).w AS best FROM p GROUP BY word),
e AS (SELECT w.word, CASE WHEN top >= {spelling.FORM_RATIO} * w.n THEN best END AS form, w.n, coalesce(n_near, 0) AS n_near,
  CASE WHEN top >= {spelling.FORM_RATIO} * w.n THEN top END AS form_n FROM w LEFT JOIN f USING (word)),
s AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM e),
g AS (WITH RECURSIVE g AS (SELECT word, root, done FROM s UNION ALL SELECT g.word, s.root, s.done FROM g JOIN s ON g.root = s.word WHERE NOT g.done) SELECT word, root FROM g WHERE done)
SELECT word, form, root, n, n_near, form_n FROM e JOIN g USING (word)""",
    "op12_prefix_trie": rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, CAST(row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS INT) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, CAST({_crc32_sql("CAST(conv_id AS VARCHAR)")} % {HEAD_TURNS} AS INT) AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.role, t.text, t.i FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.i < c.h
  UNION ALL SELECT conv_id, role, text, i FROM t JOIN c USING (conv_id) WHERE i >= h),
o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth FROM r),
m AS (SELECT conv_id, depth, text, list(struct_pack(role := role, text := text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM o
  UNION ALL SELECT conv_id, 0, '', [] FROM c),
x AS (SELECT *, CASE WHEN depth > 0 THEN path[:-2] END AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM m),
n AS (SELECT path, any_value(above) AS above, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(text) AS text,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM x GROUP BY path),
k AS (SELECT above AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS saved FROM n LEFT JOIN k USING (path)),
a AS (SELECT x.path, v.saved, v.n_children FROM v JOIN x ON x.conv_id = v.conv_id AND x.depth <= v.depth),
b AS (SELECT path, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM a GROUP BY path)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves, b.saved_tokens, v.ends_sha256
FROM v JOIN b ON v.path = b.path LEFT JOIN n p ON p.path = v.above""",
}
