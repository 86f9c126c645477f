"""Per-ticker window features: returns, rolling volatility, range, volume, target.

All windows share ``partitionBy(ticker).orderBy(date)``, so Catalyst plans them as
stacked Window nodes over a single hash exchange on ``ticker`` and a single sort.
Rolling frames are ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``; a window is only
emitted when it holds ``n`` non-null inputs (the full-window guard).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volpanel.functions.scalar import ratio, safe_sqrt
from volpanel.schemas import HORIZON, RANGE_WINDOW, TARGET, VOL_WINDOWS, VOLUME_WINDOW


def by_ticker(key: str | list[str] = "ticker", order: str = "date"):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def trailing(n: int, key="ticker", order: str = "date"):
    return by_ticker(key, order).rowsBetween(-(n - 1), Window.currentRow)


def full_window(expr: Column, c: Column, n: int, key="ticker", order: str = "date") -> Column:
    """``expr`` only where the trailing n-row frame holds n non-null values of ``c``."""
    return F.when(F.count(c).over(trailing(n, key, order)) == n, expr)


def add_return(df: DataFrame, price: str = "close", out: str = "ret", key="ticker", order: str = "date") -> DataFrame:
    """One-row simple return; a zero or missing previous price gives NULL, not an error."""
    prev = F.lag(price).over(by_ticker(key, order))
    return df.withColumn(out, ratio(F.col(price), prev) - F.lit(1.0))


def rolling_vol_sumsq(n_full: Column, s: Column, q: Column, n: int) -> Column:
    """Sample std from a window's count, Σx and Σx²: sqrt(max(0, (Σx² − (Σx)²/n) / (n−1))), full windows only."""
    var = (q - s * s / F.lit(float(n))) / F.lit(float(n - 1))
    return F.when(n_full == n, safe_sqrt(var))


def rolling_vol(c: Column, n: int, key="ticker", order: str = "date") -> Column:
    """Sample std (ddof 1) over the trailing n rows, full windows only."""
    return full_window(F.stddev_samp(c).over(trailing(n, key, order)), c, n, key, order)


def rolling_mean(c: Column, n: int, key="ticker", order: str = "date") -> Column:
    return full_window(F.avg(c).over(trailing(n, key, order)), c, n, key, order)


def add_from_blocks(df: DataFrame, asked: dict[str, tuple[str, str, int]], key="ticker", order: str = "date") -> DataFrame:
    """Adds ``name: (kind, column, n)``: the ``mean``, the ``std`` (ddof 1) or the ``sumsq`` std of the trailing n rows, full
    windows only.

    A sliding frame is summed anew for every row, so a frame of 30 rows costs six times one of 5.  Here only the shortest
    frame slides; a window of k times its rows is put together from k adjacent ones, read by ``lag`` (a missing one is NULL:
    not a full window).  Nothing is ever subtracted from a running sum, so an outlier or NaN stays in its own windows:
    sums are added, and deviations are merged around the mean of the block means.  Other lengths slide on their own.
    """
    names, shortest = df.columns, min(n for _, _, n in asked.values())
    stats = {
        "n": F.count, "s": F.sum, "q": lambda c: F.sum(c * c), "a": F.avg, "v": F.var_samp,
    }
    reads = {"mean": "ns", "std": "nav", "sumsq": "nsq"}
    slid, lagged, formulas = {}, {}, []
    for name, (kind, c, n) in asked.items():
        rows = shortest if n % shortest == 0 and (shortest > 1 or kind != "std") else n
        k = n // rows
        for st in reads[kind]:
            at = f"_{st}{rows}_{c}"
            slid[at] = stats[st](F.col(c)).over(trailing(rows, key, order))
            for j in range(1, k):
                lagged[f"{at}_{j}"] = F.lag(at, j * rows).over(by_ticker(key, order))

        def parts(st):
            return [F.col(f"_{st}{rows}_{c}" + (f"_{j}" if j else "")) for j in range(k)]

        def total(cols):
            return sum(cols[1:], cols[0])

        n_full = total(parts("n"))
        if kind == "mean":
            out = F.when(n_full == n, total(parts("s")) / F.lit(float(n)))
        elif kind == "sumsq":
            out = rolling_vol_sumsq(n_full, total(parts("s")), total(parts("q")), n)
        elif k == 1:
            out = F.when(n_full == n, F.sqrt(F.col(f"_v{rows}_{c}")))
        else:
            mean = total(parts("a")) / F.lit(float(k))
            around = total([(a - mean) * (a - mean) for a in parts("a")])
            var = (total(parts("v")) * F.lit(float(rows - 1)) + around * F.lit(float(rows))) / F.lit(float(n - 1))
            out = F.when(n_full == n, F.sqrt(var))
        formulas.append(out.alias(name))
    df = df.select("*", *[e.alias(a) for a, e in slid.items()])
    if lagged:
        df = df.select("*", *[e.alias(a) for a, e in lagged.items()])
    return df.select(*names, *formulas)


def add_vols(df: DataFrame, method: str = "sumsq", windows=VOL_WINDOWS, key="ticker", order: str = "date") -> DataFrame:
    """Adds ``vol_n`` of ``ret``.  The window sums become columns before the formula reads them: it names each of them several
    times, and a window is evaluated once for every time it is named."""
    if method != "sumsq":
        kind = "sumsq" if method == "blocks" else "std"
        return add_from_blocks(df, {f"vol_{n}": (kind, "ret", n) for n in windows}, key, order)
    c, names = F.col("ret"), df.columns
    sums = []
    for n in windows:
        w = trailing(n, key, order)
        sums += [F.count(c).over(w).alias(f"_n{n}"), F.sum(c).over(w).alias(f"_s{n}"), F.sum(c * c).over(w).alias(f"_q{n}")]
    return df.select("*", *sums).select(*names, *[rolling_vol_sumsq(F.col(f"_n{n}"), F.col(f"_s{n}"), F.col(f"_q{n}"), n).alias(f"vol_{n}") for n in windows])


def add_target(df: DataFrame, horizon: int = HORIZON, key="ticker", order: str = "date") -> DataFrame:
    """Forward target: the ``vol_h`` of the row ``h`` rows ahead (the next h returns)."""
    return df.withColumn(TARGET, F.lead(f"vol_{horizon}", horizon).over(by_ticker(key, order)))


def add_features(prices: DataFrame, method: str = "sumsq", horizon: int = HORIZON, target_end: bool = False) -> DataFrame:
    """``features``: date, ticker, close, ret, vol_5, vol_10, vol_30, target_vol_fwd.

    One row per input row (warm-up and tail rows keep NULLs).  ``method`` picks the
    variance form: ``sumsq`` (window sums), ``blocks`` (the same sums, put together from
    those of the shortest window: for large panels) or ``std`` (deviations from the mean).  With
    ``target_end`` a column ``target_end`` holds the date of the last bar the target
    looks at (``lead(date, h)``), used to purge training rows whose target overlaps a
    test period.
    """
    base = prices.select("date", "ticker", "close")
    # the target is the volatility of the next `horizon` returns: add that window if needed
    windows = tuple(sorted(set(VOL_WINDOWS) | {horizon}))
    out = add_target(add_vols(add_return(base), method, windows), horizon)
    cols = ["date", "ticker", "close", "ret", "vol_5", "vol_10", "vol_30", TARGET]
    if target_end:
        out = out.withColumn("target_end", F.lead("date", horizon).over(by_ticker()))
        cols.append("target_end")
    return out.select(*cols)


def clean_v1(features: DataFrame) -> DataFrame:
    """Model-ready rows: a full 30-row window and a known target."""
    return features.where(F.col("vol_30").isNotNull() & F.col(TARGET).isNotNull())


def clean_any(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``cols`` (±inf is kept, as in pandas)."""
    return df.na.drop("any", subset=cols)


def range_hl(df: DataFrame) -> Column:
    return ratio(F.col("high") - F.col("low"), F.col("close"))


def parkinson_term() -> Column:
    """ln(H/L)² / (4 ln 2) per row; NULL where the ratio is undefined."""
    lr = F.ln(ratio(F.col("high"), F.col("low")))
    return F.pow(lr, F.lit(2.0)) / F.lit(4.0 * math.log(2.0))


def add_features_v2(prices: DataFrame, horizon: int = HORIZON, clean: bool = True, keep: list[str] = ()) -> DataFrame:
    """``features_v2``: v1 features with the ``std`` form of the volatility, plus range and volume.

    range_hl = (H − L)/C; range_5 = 5-row mean of range_hl; parkinson_5 =
    sqrt(5-row mean of ln(H/L)²/(4 ln 2)); vol_ratio = volume / its 20-row mean.
    Rows with a NULL/NaN in any output column are dropped (unless ``clean=False``).  ``keep`` names price columns to carry along.
    """
    df = add_return(prices.select("date", "ticker", "close", "high", "low", "volume"))
    df = df.select("*", range_hl(df).alias("range_hl"), parkinson_term().alias("_park"), F.col("volume").cast("double").alias("_volume"))
    asked = {f"vol_{n}": ("std", "ret", n) for n in sorted(set(VOL_WINDOWS) | {horizon})}
    asked |= {"range_5": ("mean", "range_hl", RANGE_WINDOW), "_park_5": ("mean", "_park", RANGE_WINDOW), "_volume_20": ("mean", "_volume", VOLUME_WINDOW)}
    df = add_from_blocks(df, asked)
    df = df.select(
        "*", F.sqrt("_park_5").alias("parkinson_5"), ratio(F.col("_volume"), F.col("_volume_20")).alias("vol_ratio")
    )
    df = add_target(df, horizon)
    cols = [
        "date", "ticker", "close", "ret", "vol_5", "vol_10", "vol_30",
        "range_hl", "range_5", "parkinson_5", "vol_ratio", TARGET,
    ]
    out = df.select(*cols, *[c for c in keep if c not in cols])
    return clean_any(out, cols) if clean else out


# ---- skew-safe form for long per-ticker series (tick data) ------------------------

def sequence_numbers(df: DataFrame, key: str = "ticker", order: str = "date", n_parts: int | None = None) -> DataFrame:
    """Adds ``seq``: the 0-based position of each row in its key's ``order`` (keys unique).

    No window over a whole key: rows are range-partitioned on (key, order) — a hot key
    is split across many partitions at sampled boundaries — and numbered inside each
    sorted partition; a small table of per-(key, partition) counts (at most
    #keys + #partitions rows) gives each piece its offset.
    """
    from volpanel.session import cpu_partitions, write_once

    n = n_parts or cpu_partitions(df)
    r = df.repartitionByRange(n, key, order).sortWithinPartitions(key, order)
    # range boundaries are sampled: the numbered rows are written once, both branches below read them
    r = write_once(r.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_id")), "numbered")
    part = r.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_id0"))
    w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(key, "_pid", "_id0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return r.join(part, [key, "_pid"]).select(*df.columns, (F.col("_off") + F.col("_id") - F.col("_id0")).alias("seq"))


HALO_BACK = max(VOL_WINDOWS)  # a row's 30-return window reaches 30 closes back
HALO_AHEAD = HORIZON  # its target reaches 5 closes ahead


def add_features_blocked(
    prices: DataFrame, rows_per_block: int = 100_000, method: str = "sumsq", horizon: int = HORIZON, n_parts: int | None = None
) -> DataFrame:
    """``add_features`` with every window group bounded by ``rows_per_block`` + halo.

    Each key's rows are cut into blocks of ``rows_per_block`` consecutive rows (by
    ``seq``); a block also receives the 30 rows before it and the 5 rows after it, the
    windows run per (key, block), and only the block's own rows are kept — the same
    values as the unblocked windows, without sending a hot key to one task.
    """
    if rows_per_block < HALO_BACK + max(HALO_AHEAD, horizon) + 1:
        raise ValueError("rows_per_block must exceed the halo")
    seq = sequence_numbers(prices.select("date", "ticker", "close"), "ticker", "date", n_parts)
    r = F.lit(rows_per_block)
    blk = F.floor(F.col("seq") / r)
    pos = F.col("seq") - blk * r
    back, ahead = max(HALO_BACK, horizon), max(HALO_AHEAD, horizon)
    serves = F.array_compact(
        F.array(blk, F.when(pos >= r - back, blk + 1), F.when((pos < ahead) & (blk > 0), blk - 1))
    )
    rows = seq.select("*", blk.alias("_own"), F.explode(serves).alias("_blk"))
    keys = ["ticker", "_blk"]
    windows = tuple(sorted(set(VOL_WINDOWS) | {horizon}))
    out = add_return(rows, key=keys, order="seq")
    out = add_target(add_vols(out, method, windows, key=keys, order="seq"), horizon, key=keys, order="seq")
    out = out.where(F.col("_blk") == F.col("_own"))
    return out.select("date", "ticker", "close", "ret", "vol_5", "vol_10", "vol_30", TARGET)
