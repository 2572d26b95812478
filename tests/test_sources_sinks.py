import os

from pyspark.sql import functions as F

from tickweave.schemas import CONTRACT
from tickweave.session import shared_dir
from tickweave.sinks import writers as K
from tickweave.sources import files as S


def test_csv_universe_keeps_true_as_text(spark):
    path = shared_dir(spark, "t_csv")
    os.makedirs(path)
    with open(f"{path}/u.csv", "w") as f:
        f.write("Symbol,Name\nTRUE,True Corp\nAAPL,Apple\n")
    rows = S.read_universe_csv(spark, path).collect()
    assert [r.underlying_ticker for r in rows] == ["TRUE", "AAPL"]
    assert S.read_universe_csv(spark, path).schema["underlying_ticker"].dataType.simpleString() == "string"


def test_recursive_parquet_with_schema_fills_missing_columns(spark):
    path = shared_dir(spark, "t_parquet")
    spark.createDataFrame([("O:A", "AAPL")], "ticker string, underlying_ticker string") \
        .write.parquet(f"{path}/AAPL")
    df = S.read_landed_parquet(spark, path, CONTRACT)
    r = df.first()
    assert r.ticker == "O:A" and r.strike_price is None and df.columns == CONTRACT.fieldNames()


def test_dynamic_overwrite_is_idempotent(spark):
    path = shared_dir(spark, "t_batches")
    df = spark.range(100).withColumn("batch_id", (F.col("id") / 40).cast("int"))
    for _ in range(3):
        K.write_parquet_partitioned(df, path, ["batch_id"], dynamic_overwrite=True)
    back = spark.read.parquet(path)
    assert back.count() == 100
    one = back.where("batch_id = 1")
    assert "PartitionFilters: [isnotnull(batch_id" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 40


def test_bucketed_layout_has_a_fixed_number_of_folders(spark):
    path = shared_dir(spark, "t_buckets")
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"), "id")
    K.write_parquet_bucketed(df, path, "k", 8, max_records_per_file=100)
    back = spark.read.parquet(path)
    assert back.count() == 3000 and back.select("bucket").distinct().count() == 8
    hot = back.where(F.col("bucket") == K.bucket_of(F.lit("HOT"), 8)).where("k = 'HOT'")
    assert hot.count() == 1000 and "PartitionFilters: [isnotnull(bucket" in hot._jdf.queryExecution().executedPlan().toString()
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) <= 100


def test_scratch_can_be_cleared(spark):
    path = shared_dir(spark, "t_clear")
    spark.range(3).write.parquet(path)
    from tickweave import session
    before = session.shared_dir(spark, "x")
    assert before.startswith(session._scratch_root(spark))
    session.clear_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))


def test_scratch_needs_a_shared_folder_off_local_masters():
    from types import SimpleNamespace

    import pytest

    from tickweave import session
    conf = {"spark.master": "spark://host:7077"}
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: conf.get(k, default)))
    with pytest.raises(ValueError):
        session.checkpoint_root(fake)


def test_partitioned_write_with_clustering_reads_back(spark):
    path = shared_dir(spark, "t_by_underlying")
    df = spark.createDataFrame([(f"O:{i}", f"U{i % 5}") for i in range(50)], "ticker string, underlying_ticker string")
    K.write_parquet_partitioned(df, path, ["underlying_ticker"], cluster=["ticker"])
    back = spark.read.schema("ticker string, underlying_ticker string").parquet(path)
    assert back.count() == 50 and back.where("underlying_ticker = 'U3'").count() == 10


def test_daily_csv_and_documents(spark):
    root = shared_dir(spark, "t_daily")
    df = spark.createDataFrame([("O:A", 1.5)], "ticker string, c double")
    folder = K.write_daily_csv(df, root, "2024-09-19")
    assert folder.endswith("load_date=2024-09-19")
    assert spark.read.schema("ticker string, c double").option("header", True).csv(folder).first().c == 1.5
    docs = spark.createDataFrame([("O:A", [(1, "x")]), ("O:B", [])],
                                 "ticker string, aggs array<struct<timestamp:bigint, agg_id:string>>")
    target = shared_dir(spark, "t_docs")
    K.write_documents(docs, target, fmt="json")
    back = spark.read.schema(docs.schema).json(target)
    assert sorted((r.ticker, len(r.aggs)) for r in back.collect()) == [("O:A", 1), ("O:B", 0)]
