"""Schemas, feature sets and the fixed values results depend on."""

from __future__ import annotations

import math

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (they must equal the source's for equal results)
#   feature set v1: ret, vol_5, vol_10, vol_30
#   feature set v2: v1 + range_hl, range_5, parkinson_5, vol_ratio
#   feature set v3: v2 + vix, vix_5, vix_chg
#   set labels: "v1 (original)", "v2 (+range/vol)", "v3 (+VIX)"
#   target: target_vol_fwd; naive baseline: vol_5; horizon: 5 rows
#   rolling windows: 5, 10, 30 rows; range mean 5 rows; volume mean 20 rows
#   folds: 5 (fold 0 seeds training only); single split test fraction 0.20;
#   three-way split at 0.60 and 0.80 of the rows
#   annualisation: sqrt(252) * 100; log-target epsilon 1e-6
#   minimum closes for a forecast: 31; default universe: AAPL
#   demo request: ret 0.01, vol_5 0.015, vol_10 0.014, vol_30 0.013
# ---------------------------------------------------------------------------
V1 = ["ret", "vol_5", "vol_10", "vol_30"]
V2 = V1 + ["range_hl", "range_5", "parkinson_5", "vol_ratio"]
V3 = V2 + ["vix", "vix_5", "vix_chg"]
FEATURE_SETS = {"v1 (original)": V1, "v2 (+range/vol)": V2, "v3 (+VIX)": V3}
TARGET = "target_vol_fwd"
BASELINE = "vol_5"
HORIZON = 5
VOL_WINDOWS = (5, 10, 30)
RANGE_WINDOW = 5
VOLUME_WINDOW = 20
N_FOLDS = 5
TEST_FRAC = 0.20
SPLIT_THREE = (0.60, 0.80)
ANNUALISE = math.sqrt(252.0) * 100.0
LOG_EPS = 1e-6
MIN_CLOSES = 31
DEFAULT_UNIVERSE = ["AAPL"]
DEMO_REQUEST = {"ret": 0.01, "vol_5": 0.015, "vol_10": 0.014, "vol_30": 0.013}
PRICE_FIELDS = ["open", "high", "low", "close", "volume"]

PRICES = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("ticker", T.StringType(), False),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("volume", T.DoubleType(), True),
    ]
)

MARKET = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("vix", T.DoubleType(), True),
    ]
)

DOCUMENTED_METRICS = T.StructType(
    [
        T.StructField("method", T.StringType()),
        T.StructField("test_RMSE", T.DoubleType()),
        T.StructField("test_RMSE_std", T.DoubleType()),
        T.StructField("test_MAE", T.DoubleType()),
        T.StructField("test_R2", T.DoubleType()),
        T.StructField("baseline_RMSE", T.DoubleType()),
        T.StructField("fold_RMSEs", T.ArrayType(T.DoubleType())),
        T.StructField("improvement_vs_baseline_%", T.DoubleType()),
    ]
)

LINEAR_MODEL = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("target_horizon_days", T.IntegerType()),
        T.StructField("log_space", T.BooleanType()),
        T.StructField("documented_metrics", DOCUMENTED_METRICS),
    ]
)
