"""Versioned tables, model swaps in the stream, and rejected source lines."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from volpanel.plans import serve
from volpanel.schemas import DEMO_REQUEST, V1
from volpanel.sources import files, versions
from volpanel.streaming import scoring


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="volpanel-versions-", dir="/tmp")


def numbers(spark, n):
    return spark.range(n).withColumn("x", F.col("id") * 2)


def test_readers_see_the_newest_version(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.publish(numbers(spark, 5), path, "first") == 1
    old = versions.read(spark, path)
    assert versions.publish(numbers(spark, 8), path, partition_by=["x"]) == 2
    assert versions.read(spark, path).count() == 8 and versions.read(spark, path, 1).count() == 5
    assert old.count() == 5  # a reader keeps the version that it resolved
    assert [(r.number, r.rows, r.note) for r in versions.pointers(spark, path).orderBy("number").collect()] == [(1, 5, "first"), (2, 8, "")]
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 3)


def test_a_failing_writer_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    versions.publish(numbers(spark, 100), path)
    # tasks write rows before one of them fails
    broken = numbers(spark, 100).repartition(4).withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path)
    assert versions.read(spark, path).agg(F.sum("x")).first()[0] == 9900
    assert versions.publish(numbers(spark, 3), path) == 2 and versions.read(spark, path).count() == 3


def test_empty_version(spark, folder):
    versions.publish(numbers(spark, 0), f"{folder}/t")
    assert versions.read(spark, f"{folder}/t").count() == 0


def model(spark, intercept):
    coefs = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4, intercept)], "b0 double, b1 double, b2 double, b3 double, intercept double")
    return serve.model_row(coefs, V1)


def test_stream_stamps_the_model_of_each_batch(spark, folder):
    def lines(n, k):
        return spark.createDataFrame([(json.dumps({**DEMO_REQUEST, "id": k * 10 + i}),) for i in range(n)], "request string")

    out = scoring.score_with_versions([lines(3, 1), lines(2, 2), lines(4, 3)], [model(spark, 0.001), model(spark, 0.002), model(spark, 0.001)], folder)
    got = sorted((r.model_version, round(r.pred_daily_vol, 6)) for r in out.collect())
    assert got == [(1, 0.0144)] * 3 + [(2, 0.0154)] * 2 + [(3, 0.0144)] * 4


def test_a_repeated_batch_leaves_no_response_twice(spark, folder):
    versions.publish(model(spark, 0.001), f"{folder}/model")
    spark.createDataFrame([(json.dumps(DEMO_REQUEST),)] * 3, "request string").coalesce(1).write.text(f"{folder}/requests")
    for checkpoint in ("a", "b"):  # without its progress a stream reads the same files as batch 0 again
        q = scoring.start_versioned_scoring(spark, f"{folder}/requests", f"{folder}/model", f"{folder}/out", f"{folder}/{checkpoint}")
        q.awaitTermination()
        assert q.exception() is None
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_every_line_is_a_bar_or_rejected(spark, folder):
    lines = [
        "Date,Ticker,Open,High,Low,Close,Volume", "2024-01-02,A,1,2,0.5,1.5,100", "2024-01-03, A ,1e0,2,,,100", "", "2024-13-01,A,1,2,1,1,1", ",A,1,2,1,1,1",
        "2024-01-04,,1,2,1,1,1", "2024-01-04,A,1,2,1,1", "2024-01-04,A,1,2,1,1,1,9", "2024-01-04,A,1,2,1,one,1", "2024-01-04,A,1,2,1,1,1.5d", '"2024-01-05","A",1,2,1,"1",7']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/csv")
    bars, rejected = files.read_price_lines(spark, f"{folder}/csv")
    assert [(str(r.date), r.ticker, r.low, r.close, r.volume) for r in bars.orderBy("date").collect()] == [("2024-01-02", "A", 0.5, 1.5, 100.0), ("2024-01-03", "A", None, None, 100.0), ("2024-01-05", "A", 1.0, 1.0, 7.0)]
    got = {r.line: r.reason for r in rejected.collect()}
    assert got == {lines[4]: "date", lines[5]: "date", lines[6]: "ticker", lines[7]: "fields", lines[8]: "fields", lines[9]: "close", lines[10]: "volume"}
    assert all("csv" in r.file for r in rejected.collect())
    assert files.guarded(bars).count() == 3
    with pytest.raises(files.EmptySourceError):
        files.guarded(bars.where("ticker = 'none'"))
    with pytest.raises(ValueError, match="duplicate"):
        files.guarded(bars.unionByName(bars))
