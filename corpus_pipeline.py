"""The corpus pipeline: five stages over ``documents``, each through one of the llm operators.

Every stage gets what its predecessor kept and returns the columns of documents; the last adds the
token ids. The stages are written as Parquet and read again one after another.

1. language_id: a text without a letter, or of which no language gets ``MIN_SCORE``, goes.
2. line_dedup: lines on ten sites or more stay at their first occurrence only.
3. simhash: of each class of near-duplicates the document with the smallest id stays.
4. decontamination: a document that holds a benchmark item (in whatever order) goes.
5. sentencepiece: adds the ids of the whole text and what they decode to.

Edge cases are those of the operators. A NULL text goes in stage 1. A document that line dedup
leaves empty meets the other empty ones in one class of stage 3. Of rows that share an id, stage 3
keeps all rows of the id that stays. A NULL id is a class of its own in stage 3 (smallest id NULL)
and a document like any other elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm import decontaminate, language_id, line_dedup, piece_codec, simhash
from barframe.llm.queries import model_path
from barframe.llm.words import BATCH_ROWS
from barframe.plans.workspace import scratch_path

#: A text whose most probable language stays below this mean probability is rejected.
MIN_SCORE = 0.3


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark)
    net = language_id.fit(docs, "doc_id", "text", "lang")
    found = language_id.predict(docs, net, "text")
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark)
    classes = simhash.simhash_classes(docs)
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("kept")), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark)
    pairs = decontaminate.contaminated_pairs(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = pairs.select(F.col("doc_id").alias("leaked"), "text_mark").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("leaked")) & (F.xxhash64("text") == F.col("text_mark"))
    return docs.join(leaked, same, "left_anti")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _batches(spark)
    return piece_codec.encode_digests(docs, model_path())


def _batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_boilerplate),
    ("simhash", keep_first_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
