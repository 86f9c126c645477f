"""File and table sources/sinks for price panels and derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volpanel.functions.scalar import to_double
from volpanel.schemas import PRICE_FIELDS, PRICES


class EmptySourceError(RuntimeError):
    pass


def read_prices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Long daily bars with the explicit ``PRICES`` schema (no inference).

    CSV files carry a header; names are lower-cased and the date is parsed once here.
    """
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
        raw = lower_names(raw)
        return raw.select(
            F.to_date("date").alias("date"),
            F.col("ticker").cast("string").alias("ticker"),
            *[F.col(c).try_cast("double").alias(c) for c in PRICE_FIELDS],
        )
    if fmt == "parquet":
        df = lower_names(spark.read.parquet(path))
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRICES.fields])
    if fmt == "table":
        return lower_names(spark.table(path))
    raise ValueError(f"unknown format {fmt!r}")


PRICE_LINE = "date string, ticker string, open string, high string, low string, close string, volume string, _broken string"


def read_price_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bars, rejected) of CSV text files with the columns of ``PRICES`` and a header line each.

    Every line that is neither blank nor a header is a bar or is rejected, as (file, line, reason): ``fields`` (not one value per
    column), ``date`` (no date), ``ticker`` (empty), or the name of the first field that holds text but no number.  An empty number is a NULL, no
    fault.  One scan, two views of it; nothing is dropped silently."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    names = [f.name for f in PRICES.fields]
    lines = lines.where((F.trim("line") != "") & (F.lower(F.regexp_replace("line", r"[\s\"]", "")) != ",".join(names)))
    row = lines.select("*", F.from_csv("line", PRICE_LINE, {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}).alias("r"))
    value = {c: F.trim(F.col(f"r.{c}")) for c in names}
    number = {c: to_double(value[c]) for c in PRICE_FIELDS}
    reason = F.when(F.col("r._broken").isNotNull(), "fields").when(value["date"].try_cast("date").isNull(), "date")
    reason = reason.when(F.coalesce(value["ticker"], F.lit("")) == "", "ticker")
    for c in PRICE_FIELDS:
        reason = reason.when((F.coalesce(value[c], F.lit("")) != "") & number[c].isNull(), c)
    row = row.withColumn("reason", reason)
    bars = row.where("reason is null").select(value["date"].try_cast("date").alias("date"), value["ticker"].alias("ticker"), *[number[c].alias(c) for c in PRICE_FIELDS])
    return bars, row.where("reason is not null").select("file", "line", "reason")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def fmt_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def lookback(df: DataFrame, as_of, months: int = 6, col: str = "date") -> DataFrame:
    """Rows in the ``months`` before ``as_of`` (inclusive of both ends)."""
    as_of_c = F.lit(as_of) if not isinstance(as_of, Column) else as_of
    return df.where((F.col(col) >= F.add_months(as_of_c, -months)) & (F.col(col) <= as_of_c))


def require_rows(df: DataFrame, msg: str) -> DataFrame:
    """Raise when the source came back empty (one probe row, not a count)."""
    if df.isEmpty():
        raise EmptySourceError(msg)
    return df


def assert_unique(df: DataFrame, keys: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """Raise when a key occurs twice (windows assume one row per (ticker, date))."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    if not dup.isEmpty():
        raise ValueError(f"duplicate keys {keys}: e.g. {dup.first().asDict()}")
    return df


def guarded(df: DataFrame, msg: str = "the source holds no bars", keys: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """``df`` after both guards of a source: it has rows, and one row per key."""
    return assert_unique(require_rows(df, msg), keys)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def ordered(df: DataFrame, *keys: str, within_partitions: bool = False) -> DataFrame:
    """Key order for final output (a global sort), or only inside partitions before a write."""
    keys = keys or ("ticker", "date")
    return df.sortWithinPartitions(*keys) if within_partitions else df.orderBy(*keys)


def preview(df: DataFrame, n: int = 6, order: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """First ``n`` rows in key order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def to_long(wide: DataFrame, tickers: list[str], fields: list[str] = PRICE_FIELDS, date: str = "date") -> DataFrame:
    """Wide quotes (one column ``{ticker}_{field}`` per pair) → long rows (date, ticker, fields…).

    Rows where every field is NULL are kept (the newer stacking behaviour).
    """
    cols = [
        F.struct(F.lit(t).alias("ticker"), *[F.col(f"`{t}_{f}`").cast("double").alias(f) for f in fields])
        for t in tickers
    ]
    return wide.select(F.col(date).alias("date"), F.inline(F.array(*cols)))


def to_wide(long: DataFrame, tickers: list[str] | None = None, fields: list[str] = PRICE_FIELDS) -> DataFrame:
    """Long → wide (the shape a quote downloader returns), for the tickers asked for or all of the table's.

    A wide table has a column per ticker, so Spark bounds the tickers found
    (``spark.sql.pivotMaxValues``, an error beyond it).  One value per (date, ticker)."""
    wide = long.groupBy("date").pivot("ticker", tickers) if tickers else long.groupBy("date").pivot("ticker")
    return wide.agg(*[F.max(f).alias(f) for f in fields])


def wide_tickers(wide: DataFrame, field: str = PRICE_FIELDS[0]) -> list[str]:
    """The tickers of a wide table, read off its column names."""
    return [c.removesuffix(f"_{field}") for c in wide.columns if c.endswith(f"_{field}")]
