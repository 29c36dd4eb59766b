import brute
import corpus_pipeline
from cases import passage

from barframe.llm import language_id, line_dedup
from barframe.llm.queries import model_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(-1, None, "en", "a", 0), (-2, "12 34", "en", "a", 5), (-3, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    docs = docs.unionByName(extra.select(*[F.col(c).cast(t) for c, t in docs.dtypes]))
    columns, counts = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_dir}/{i}")
        docs = spark.read.parquet(f"{tmp_dir}/{i}")
        assert docs.columns[: len(columns)] == columns
        assert len(docs.columns) == len(columns) or name == "sentencepiece"
        counts.append(docs.count())
    assert not {r[0] for r in docs.select("doc_id").collect()} & {-1, -2, -3}
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100


def test_pipeline_equals_brute_force(spark, tmp_dir):
    """Given tables with planted copies, boilerplate, leaks and odd texts, against plain Python on the same network."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leak = max((t for _, t in items if t), key=len).split()
    half = len(leak) // 2
    texts = docs.orderBy("doc_id").limit(60).collect()
    planted = [(10_000 + i, r["text"] + f"\ncommon line of many sites\nown {i}", "en", f"site{i}", 0) for i, r in enumerate(texts)]
    planted += [
        (20_000, " ".join(["before", *leak[half:], "between", *leak[:half]]), "en", "a", 0), (20_001, None, "en", "a", 0), (20_002, "", "en", "a", 0),
        (20_003, "12 34 !", None, None, None), (20_004, passage(0, 4000), None, None, None), (20_005, texts[0]["text"], "en", None, 0),
    ]
    made = spark.createDataFrame(planted, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.unionByName(made.select(*[F.col(c).cast(t) for c, t in docs.dtypes])).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    net = language_id.fit(docs, "doc_id", "text", "lang")
    want = brute.pipeline(rows, items, net, model_path(), corpus_pipeline.MIN_SCORE, line_dedup.MIN_SITES)
    got = {r["doc_id"]: (r["text"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, tmp_dir).collect()}
    assert got == want and 20 < len(want) < len(rows) - 60
    assert 20_000 not in got and any(len(want[i][0].split("\n")) > 1 for i in want)


def test_run_of_the_whole_pipeline(spark):
    assert {"doc_id", "text", "n_tokens"} <= set(corpus_pipeline.run(spark, SF).columns)
