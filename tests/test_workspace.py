from respondry.sources import workspace


def test_tables_go_to_the_named_folder(spark):
    folder = workspace.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir")
    assert folder == f"{named}/respondry-{spark.sparkContext.applicationId}"
    assert workspace.written(spark.range(3), "t").inputFiles()[0].removeprefix("file://").startswith(folder.removeprefix("file://"))


def test_written_keeps_columns_and_rows(spark):
    df = spark.range(10).selectExpr("id", "cast(id % 3 as int) AS part")
    back = workspace.written(df, "t", partition_by=("part",))
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).isEmpty() and back.count() == 10
    plan = back.filter("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
