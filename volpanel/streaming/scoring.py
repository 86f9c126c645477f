"""Request scoring as a Structured Streaming query.

Requests arrive as JSON lines in files under a directory (one request per line).  The
transform is the stateless batch ``score_requests`` joined with the static one-row
model (a stream–static broadcast join), so a stream and a batch over the same lines
give the same responses.  No state, watermark or window is involved: each request is
answered on its own, and the file source plus a checkpoint location give exactly-once
output across restarts and lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volpanel.plans.serve import score_requests
from volpanel.session import write_path
from volpanel.sources import versions


def read_request_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of raw request lines: (source_file, request)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.input_file_name().alias("source_file"), F.col("value").alias("request"))


def read_request_batch(spark: SparkSession, path: str) -> DataFrame:
    """The same lines as a batch DataFrame."""
    return spark.read.format("text").load(path).select(
        F.input_file_name().alias("source_file"), F.col("value").alias("request")
    )


def score_stream(requests: DataFrame, model: DataFrame) -> DataFrame:
    """Streaming responses: request columns + statusCode, outputs, error and JSON body."""
    return score_requests(requests, model)


def start_scoring(
    spark: SparkSession,
    request_dir: str,
    model: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
):
    """Start the stream: text lines → responses → Parquet files (append)."""
    responses = score_stream(read_request_stream(spark, request_dir), model)
    writer = (
        responses.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def start_versioned_scoring(
    spark: SparkSession, request_dir: str, model_table: str, out_dir: str, checkpoint_dir: str, max_files_per_trigger: int | None = None, available_now: bool = True
):
    """Start the stream with a model that may change while it runs.

    ``model_table`` is a versioned table of one-row models (``sources.versions``).  Each micro-batch resolves the newest
    published version when it starts and stamps its number on every response.  A batch's responses go to a
    folder of their own that a repeated batch replaces, so a restart leaves no response twice; no model is fitted in the stream."""
    def answer(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        version = versions.current(session, model_table)
        if version is None:
            raise FileNotFoundError(f"no published model under {model_table}")
        model = versions.read(session, model_table, version["number"])
        scored = score_requests(batch, model).withColumn("model_version", F.lit(version["number"]).cast("long"))
        scored.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    writer = read_request_stream(spark, request_dir, max_files_per_trigger).writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def score_with_versions(requests: list[DataFrame], models: list[DataFrame], workdir: str | None = None) -> DataFrame:
    """Responses of a stream that gets ``requests[k]`` (column ``request``) after ``models[k]`` was published."""
    spark = models[0].sparkSession
    base = f"{workdir.rstrip('/')}/swap" if workdir else write_path(spark, "swap")
    for part, model in zip(requests, models):
        versions.publish(model, f"{base}/model")
        part.select("request").write.mode("append").text(f"{base}/requests")
        q = start_versioned_scoring(spark, f"{base}/requests", f"{base}/model", f"{base}/responses", f"{base}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"scoring stream failed: {q.exception()}")
    return spark.read.parquet(f"{base}/responses")


def score_through_stream(requests: DataFrame, model: DataFrame, workdir: str | None = None) -> DataFrame:
    """Run request lines through the streaming query and return the sink's contents.

    ``requests`` holds a ``request`` column of JSON text.  The lines are written under
    ``workdir`` (default: the shared folder named by ``spark.checkpoint.dir``), scored by
    an ``availableNow`` stream with its own checkpoint, and the Parquet sink is read back.
    """
    import uuid

    from volpanel.session import ensure_checkpoint_dir

    spark = requests.sparkSession
    base = (workdir or ensure_checkpoint_dir(spark)).rstrip("/") + f"/stream-{uuid.uuid4().hex}"
    requests.select("request").write.mode("overwrite").text(f"{base}/requests")
    q = start_scoring(spark, f"{base}/requests", model, f"{base}/responses", f"{base}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"scoring stream failed: {q.exception()}")
    return spark.read.parquet(f"{base}/responses")
