"""GARCH(1,1) with zero mean, per ticker.

Model: rₜ = σₜ·εₜ, σ²ₜ₊₁ = ω + α·r²ₜ + β·σ²ₜ, on percent returns (ret × 100) of the
training rows.  Two forms:

* ``garch_grid`` – variance targeting (ω = v̄·(1 − α − β), v̄ = mean r², σ²₁ = v̄) and
  the Gaussian log-likelihood evaluated on a fixed (α, β) grid, all tickers of a few and all
  candidates as one vector recursion (NumPy inside ``mapInArrow``); checkable in SQL.
* ``garch_fit`` – the same likelihood maximised per ticker with ω free: a coarse grid over the
  whole region α, β ≥ 0, α + β < 1, then a pattern search that re-centres while it improves and
  halves its steps when it does not, until they are negligible (``converged``).  All tickers of a
  batch and all candidates of a round are one vector recursion (NumPy inside ``mapInPandas``).

A ticker's return array holds one value per trading day, so its size is bounded by
the calendar span, not by the data volume.  The forecast is the mean of the 1…h
step variance forecasts, as volatility: sqrt(mean)/100.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volpanel.session import cpu_partitions, write_once

LN_2PI = math.log(2.0 * math.pi)

# search grid over the whole region α, β ≥ 0, α + β < 1 (α = 0 makes every β the same model: one entry)
ALPHAS = [0.02, 0.05, 0.10, 0.15, 0.20, 0.30, 0.40, 0.55, 0.70, 0.85]
BETAS = [0.00, 0.15, 0.30, 0.45, 0.60, 0.70, 0.80, 0.88, 0.94]
GRID = [(0.0, 0.0)] + [(a, b) for a in ALPHAS for b in BETAS if a + b < 0.995]


def return_arrays(df: DataFrame, ret: str = "ret", key: str = "ticker", order: str = "date", scale: float = 100.0) -> DataFrame:
    """(ticker, r ARRAY<DOUBLE> in date order, n, vbar = mean r²) from the training rows."""
    g = df.where(F.col(ret).isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("d"), (F.col(ret) * F.lit(scale)).alias("r")))).alias("_s")
    )
    r = F.transform(F.col("_s"), lambda s: s["r"])
    return g.select(key, r.alias("r")).select(
        key,
        "r",
        F.size("r").alias("n"),
        (F.aggregate("r", F.lit(0.0), lambda acc, x: acc + x * x) / F.size("r")).alias("vbar"),
    )


def loglik(r: Column, omega: Column, alpha: Column, beta: Column, s2_0: Column) -> Column:
    """struct(s2 = σ² after the last return, ll = Σ −½(ln 2π + ln σ²ₜ + r²ₜ/σ²ₜ))."""
    init = F.struct(s2_0.alias("s2"), F.lit(0.0).alias("ll"))
    return F.aggregate(
        r,
        init,
        lambda acc, x: F.struct(
            (omega + alpha * x * x + beta * acc["s2"]).alias("s2"),
            (acc["ll"] - F.lit(0.5) * (F.lit(LN_2PI) + F.ln(acc["s2"]) + x * x / acc["s2"])).alias("ll"),
        ),
    )


def mean_forecast(vbar: Column, s2_next: Column, phi: Column, h: int) -> Column:
    """Mean of the 1…h step variance forecasts: v̄ + (σ²ₙ₊₁ − v̄)·(1 + φ + … + φ^{h−1})/h."""
    geo = F.lit(1.0)
    term = F.lit(1.0)
    for _ in range(1, h):
        term = term * phi
        geo = geo + term
    return vbar + (s2_next - vbar) * geo / F.lit(float(h))


def garch_grid(train: DataFrame, horizon: int = 5, grid: list[tuple[float, float]] = GRID) -> DataFrame:
    """Per ticker: best (α, β) on the grid, ω, log-likelihood and the volatility forecast."""
    arr = return_arrays(train.select("ticker", "date", "ret")).where((F.col("n") >= 2) & (F.col("vbar") > 0))
    # one row per ticker, small in bytes but CPU-heavy: spread round-robin over the cluster
    arr = arr.repartition(cpu_partitions(train))
    a, b = (np.array(v) for v in zip(*grid))

    def best_of(batches):
        for batch in batches:
            names, vbar = batch.column(0), batch.column(2).to_numpy()
            if not len(vbar):
                continue
            r2, n = squares([np.asarray(r) for r in split_lists(batch.column(1))])
            omega = vbar[:, None] * (1.0 - a - b)[None, :]
            ll, s2 = _recursion(r2, n, omega, np.repeat(a[None, :], len(n), axis=0), np.repeat(b[None, :], len(n), axis=0), vbar)
            rows, i = np.arange(len(n)), np.argmax(ll, axis=1)  # the first of equals
            cols = {"alpha": a[i], "beta": b[i], "omega": omega[rows, i], "loglik": ll[rows, i], "_s2": s2[rows, i], "_vbar": vbar}
            yield pa.RecordBatch.from_arrays([names, *map(pa.array, cols.values())], ["ticker", *cols])

    schema = f"ticker {arr.schema['ticker'].dataType.simpleString()}, alpha double, beta double, omega double, loglik double, _s2 double, _vbar double"
    found = arr.select("ticker", "r", "vbar").mapInArrow(best_of, schema)
    var = mean_forecast(F.col("_vbar"), F.col("_s2"), F.col("alpha") + F.col("beta"), horizon)
    return found.select("ticker", "alpha", "beta", "omega", "loglik", (F.sqrt(var) / F.lit(100.0)).alias("garch_vol"))


# ---- long series: the recursion as an associative scan over pieces -------------------

def loglik_in_pieces(
    df: DataFrame, alpha: float, beta: float, ret: str = "ret", key: str = "ticker", order: str = "date", scale: float = 100.0, n_parts: int | None = None, rows_per_piece: int = 50_000
) -> DataFrame:
    """(key, n, vbar, s2 after the last return, loglik) under variance targeting, for keys of any length.

    The variance recursion is an affine map, s2 -> omega + alpha * r**2 + beta * s2, and affine maps compose: a piece of
    consecutive returns is (add, mul) with s2_out = add + mul * s2_in.  Rows are range-partitioned by (key, order) and cut into pieces of
    at most ``rows_per_piece``; a scan over the few pieces of a key gives each piece the variance that it starts with, and
    the pieces' likelihoods are summed.  No array and no task holds a whole key.  Equal to the fold over the whole series up to
    the rounding of the sums."""
    if not (alpha >= 0 and beta >= 0 and alpha + beta < 1):
        raise ValueError("alpha and beta must be a stationary pair")
    n = n_parts or cpu_partitions(df)
    r = df.where(F.col(ret).isNotNull()).select(key, order, (F.col(ret) * F.lit(scale)).alias("_r"))
    r = r.repartitionByRange(n, key, order).sortWithinPartitions(key, order, "_r")
    # range bounds are sampled: the numbered rows are written once for all readers
    r = write_once(r.select(key, "_r", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "returns")
    # a piece is a stretch of one partition's numbers, so pieces of a key follow each other by their number
    piece = F.floor(F.col("_at") / F.lit(rows_per_piece))
    part = r.groupBy(key, piece.alias("_piece")).agg(F.array_sort(F.collect_list(F.struct("_at", "_r"))).alias("_s"))
    part = write_once(part.select(key, "_piece", F.transform("_s", lambda s: s["_r"]).alias("_x")), "pieces")
    squares = F.aggregate("_x", F.lit(0.0), lambda acc, x: acc + x * x)
    size = part.groupBy(key).agg(F.sum(F.size("_x")).cast("long").alias("n"), F.sum(squares).alias("_sq")).where((F.col("n") >= 2) & (F.col("_sq") > 0))
    size = size.select(F.col(key).alias("_key"), "n", (F.col("_sq") / F.col("n")).alias("vbar"))
    part = part.join(size, F.col(key) == F.col("_key")).withColumn("_omega", F.col("vbar") * F.lit(1.0 - alpha - beta))
    add = F.aggregate("_x", F.lit(0.0), lambda acc, x: F.col("_omega") + F.lit(alpha) * x * x + F.lit(beta) * acc)
    maps = part.select(key, "_piece", F.struct(add.alias("add"), F.pow(F.lit(float(beta)), F.size("_x")).alias("mul")).alias("_map"), "vbar")
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    start = F.aggregate(F.collect_list("_map").over(before), F.col("vbar"), lambda s2, m: m["add"] + m["mul"] * s2)
    starts = maps.select(F.col(key).alias("_k"), F.col("_piece").alias("_p"), start.alias("_s2"))
    run = part.join(starts, (F.col(key) == F.col("_k")) & (F.col("_piece") == F.col("_p")))
    run = run.select(key, "_piece", "n", "vbar", loglik(F.col("_x"), F.col("_omega"), F.lit(float(alpha)), F.lit(float(beta)), F.col("_s2")).alias("_res"))
    return run.groupBy(key).agg(F.max("n").alias("n"), F.max("vbar").alias("vbar"), F.max_by("_res", "_piece")["s2"].alias("s2"), F.sum("_res.ll").alias("loglik"))


# ---- free-ω refinement per ticker (NumPy inside mapInPandas) -----------------------

EDGE = 0.9999  # largest α + β
ROUNDS = 200
LEAST_STEP = 1e-4
LEAST_GAIN = 1e-4  # log-likelihood units


TICKERS = 64  # tickers of one vector recursion: its arrays stay in a core's cache
BATCH = 1024  # tickers fitted together


def split_lists(column: pa.ListArray) -> list[np.ndarray]:
    """The values of each list."""
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1])


def squares(series: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(r² as tickers × time, zero-padded; lengths) of series of percent returns."""
    n = np.array([len(r) for r in series])
    r2 = np.zeros((len(series), int(n.max())))
    for k, r in enumerate(series):
        r2[k, : len(r)] = r * r
    return r2, n


def _recursion(r2: np.ndarray, n: np.ndarray, omega: np.ndarray, alpha: np.ndarray, beta: np.ndarray, vbar: np.ndarray):
    """Log-likelihood and next variance for tickers × candidates.

    r2: tickers × time (zero-padded behind n), omega/alpha/beta: tickers × candidates.  Tickers of like length run
    together, candidates × tickers, in place; a ticker leaves when its series ends."""
    ll, s2 = np.empty(omega.shape), np.empty(omega.shape)
    order = np.argsort(-n, kind="stable")
    for lo in range(0, len(order), TICKERS):
        own = order[lo : lo + TICKERS]
        ll[own], s2[own] = _run(r2[own, : n[own[0]]].T.copy(), n[own], omega[own].T.copy(), alpha[own].T.copy(), beta[own].T.copy(), vbar[own])
    return np.where(np.isfinite(ll), ll, -np.inf), s2


def _run(x2: np.ndarray, n: np.ndarray, omega: np.ndarray, alpha: np.ndarray, beta: np.ndarray, vbar: np.ndarray):
    """``_recursion`` of a few tickers, longest first; x2: time × tickers, the others candidates × tickers."""
    live = len(n) - np.searchsorted(n[::-1], np.arange(len(x2)), side="right")  # tickers with a return at each time
    s2_all, ll_all = np.empty(omega.shape), np.empty(omega.shape)
    w, a, b, s2, ll = omega, alpha, beta, np.repeat(vbar[None, :], len(omega), axis=0), np.zeros(omega.shape)
    term, part = np.empty(omega.shape), np.empty(omega.shape)
    for t, k in enumerate(live):
        if k < w.shape[1]:
            s2_all[:, k : w.shape[1]], ll_all[:, k : w.shape[1]] = s2[:, k:], ll[:, k:]
            # whole arrays again: a logarithm's last bit may depend on how its argument lies in memory
            w, a, b, s2, ll, term, part = (v[:, :k].copy() for v in (w, a, b, s2, ll, term, part))
        x = x2[t, :k]
        np.log(s2, out=term)
        term += LN_2PI
        np.divide(x, s2, out=part)
        term += part
        term *= 0.5
        ll -= term
        np.multiply(a, x, out=part)
        part += w
        s2 *= b
        s2 += part
        np.maximum(s2, 1e-300, out=s2)
    s2_all[:, : w.shape[1]], ll_all[:, : w.shape[1]] = s2, ll
    return ll_all.T, s2_all.T


def fit_batch(series: list[np.ndarray], horizon: int) -> list[tuple]:
    """Per series of percent returns: (omega, alpha, beta, loglik, volatility, converged).

    A series leaves the search when its own steps are negligible, so its fit does not depend on the others."""
    r2, n = squares(series)
    vbar = np.array([r2[k, :m].sum() / m for k, m in enumerate(n)])  # over its own returns: a sum's rounding depends on its length

    def evaluate(own, a, b, m):
        """Candidates (tickers × K): α, β and the unconditional variance as a multiple of v̄."""
        ok = (a >= 0) & (b >= 0) & (a + b <= EDGE) & (m > 0)
        a, b, m = np.where(ok, a, 0.0), np.where(ok, b, 0.0), np.where(ok, m, 1.0)
        w = m * vbar[own][:, None] * (1.0 - a - b)
        ll, s2 = _recursion(r2[own], n[own], w, a, b, vbar[own])
        ll = np.where(ok, ll, -np.inf)
        rows, i = np.arange(len(own)), np.argmax(ll, axis=1)
        return np.stack([v[rows, i] for v in (a, b, m, w, ll, s2)])

    grid = np.array([(a, b, m) for a in (0.01, 0.05, 0.1, 0.2, 0.35, 0.6, 0.85) for b in (0.0, 0.2, 0.4, 0.6, 0.75, 0.85, 0.92, 0.97) for m in (0.6, 1.0, 1.6) if a + b < 0.99]).T
    best = evaluate(np.arange(len(series)), *(np.repeat(g[None, :], len(series), axis=0) for g in grid))
    # steps in α, β and log m; every combination of -1, 0, 1 steps is tried at once
    move = np.array([(x, y, z) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)], float)
    step = np.full(len(series), 1.0)
    size = np.array([0.08, 0.1, 0.35])
    for _ in range(ROUNDS):
        open_ = np.flatnonzero(step * size[1] >= LEAST_STEP)
        if not len(open_):
            break
        now = best[:, open_]
        d = move[None, :, :] * (step[open_, None, None] * size)
        a = np.maximum(now[0][:, None] + d[:, :, 0], 0.0)
        b = np.clip(now[1][:, None] + d[:, :, 1], 0.0, np.maximum(EDGE - a, 0.0))
        new = evaluate(open_, a, b, now[2][:, None] * np.exp(d[:, :, 2]))
        better = new[4] > now[4] + LEAST_GAIN
        best[:, open_] = np.where(better, new, now)
        step[open_] = np.where(better, step[open_], step[open_] / 2)
    done = step * size[1] < LEAST_STEP
    alpha, beta, _, omega, ll, s2 = best
    f, total = s2, np.zeros(len(series))
    for _ in range(horizon):
        total += f
        f = omega + (alpha + beta) * f
    vol = np.sqrt(total / horizon) / 100.0
    return [tuple(float(v[k]) for v in (omega, alpha, beta, ll, vol)) + (bool(done[k]),) for k in range(len(series))]


FIT_SCHEMA = "ticker string, omega double, alpha double, beta double, loglik double, garch_vol double, converged boolean, status string"


def garch_fit(train: DataFrame, horizon: int = 5) -> DataFrame:
    """Per ticker likelihood maximisation (ω, α, β free) and the volatility forecast.

    Each ticker's ordered percent returns are one array row (bounded by the calendar);
    the rows are spread round-robin and fitted batch by batch in ``mapInPandas``.  Every ticker gets a
    row: ``status`` says ``fitted``, ``short`` (fewer than two returns) or ``constant`` (no variance),
    the last two without a forecast.
    """
    arr = return_arrays(train.select("ticker", "date", "ret"), scale=1.0).select("ticker", "r")
    arr = arr.repartition(cpu_partitions(train))

    def fit_batches(batches):
        for pdf in batches:
            series = {t: np.asarray(r, dtype=float) * 100.0 for t, r in zip(pdf["ticker"], pdf["r"])}
            good = [t for t, r in series.items() if len(r) >= 2 and (r * r).mean() > 0]
            got = {}
            for lo in range(0, len(good), BATCH):
                own = good[lo : lo + BATCH]
                got |= dict(zip(own, fit_batch([series[t] for t in own], horizon)))
            out = [(t, *got[t], "fitted") if t in got else (t, None, None, None, None, None, None, "short" if len(r) < 2 else "constant") for t, r in series.items()]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FIT_SCHEMA.split(", ")])

    return arr.mapInPandas(fit_batches, FIT_SCHEMA)
