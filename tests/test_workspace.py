from barframe.plans.workspace import cut_lineage, scratch_path, work_dir


def test_work_dir_comes_from_the_session(spark):
    base = work_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:  # the cluster's setting wins
        assert base == configured.rstrip("/")
    else:  # a local test session got its own folder, registered as the checkpoint dir
        assert spark.sparkContext.getCheckpointDir() is not None
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_cut_lineage_is_a_reliable_checkpoint(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    cut = cut_lineage(df)
    plan = cut._jdf.queryExecution().logical().toString()
    assert "LogicalRDD" in plan and "Range" not in plan
    assert cut.count() == 100
