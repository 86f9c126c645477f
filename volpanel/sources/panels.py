"""Adapters from the TPC-H-ish test tables to price panels.

Every adapter returns a long panel ``(date, ticker, open, high, low, close, volume)``
keyed by ``(ticker, date)``.  Bars are built with exact aggregates only (``min``,
``max``, ``min_by``, ``max_by`` and sums of whole numbers), so two engines agree to
the bit.  Days of many ticks (``flag_day``) go through a partial + final aggregate, so a
hot flag is pre-aggregated map-side.  Supplier days hold hardly more than one tick each,
where a partial aggregate sorts every row and takes hardly any away: their rows are dealt
by (supplier, day), so that a hot supplier is spread over its days, and sorted once.
Either way each ticker then holds at most one row per calendar day, which bounds every
per-ticker window downstream by the calendar, not by the volume of the source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def _ticks(spark: SparkSession, sf_dir: str, key: str, dealt: bool) -> DataFrame:
    """(key, date, tick, l_quantity, ord) of every line; ``dealt`` moves the bare lines to their (key, date) first."""
    li = table(spark, sf_dir, "lineitem").select(key, F.to_date("l_shipdate").alias("date"), *ORDER)
    if dealt:
        li = li.repartition(key, "date")
    return li.select(
        key,
        "date",
        # a zero quantity gives a NULL tick; its row still counts for the volume
        F.try_divide("l_extendedprice", "l_quantity").alias("tick"),
        "l_quantity",
        # deterministic ordering key for open / close: the first four fields are
        # not unique on their own, the quantity breaks the remaining ties
        F.struct(*ORDER).alias("ord"),
    )


def _bar_aggs() -> list[Column]:
    return [
        F.min_by("tick", F.when(F.col("tick").isNotNull(), F.col("ord"))).alias("open"),
        F.max("tick").alias("high"),
        F.min("tick").alias("low"),
        F.max_by("tick", F.when(F.col("tick").isNotNull(), F.col("ord"))).alias("close"),
        F.sum("l_quantity").alias("volume"),
    ]


def supplier_ticker(key: Column) -> Column:
    """``S`` + zero-padded supplier key; keys wider than six digits are kept whole."""
    return F.format_string("S%06d", key)


def supplier_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per (supplier, ship date) from ``lineitem``: the default price panel."""
    bars = _ticks(spark, sf_dir, "l_suppkey", dealt=True).groupBy("l_suppkey", "date").agg(*_bar_aggs())
    return bars.select(
        "date", supplier_ticker(F.col("l_suppkey")).alias("ticker"), "open", "high", "low", "close", "volume"
    )


def flag_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per (return flag, ship date): few tickers, many ticks per bar."""
    bars = _ticks(spark, sf_dir, "l_returnflag", dealt=False).groupBy("l_returnflag", "date").agg(*_bar_aggs())
    return bars.select(
        "date", F.col("l_returnflag").alias("ticker"), "open", "high", "low", "close", "volume"
    )


def market_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-wide daily series ``(date, vix)`` from ``orders``: stand-in for the index."""
    o = table(spark, sf_dir, "orders")
    return (
        o.select(F.to_date("o_orderdate").alias("date"), "o_totalprice", "o_orderkey")
        .groupBy("date")
        .agg(F.max_by("o_totalprice", "o_orderkey").alias("vix"))
    )


def user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick panel from ``events``: ticker = user id, one close per event time."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("date"),
        F.format_string("U%d", F.col("user_id")).alias("ticker"),
        F.col("value").alias("close"),
    )
