import json
import math
import tempfile

from pyspark.sql import functions as F

from volpanel.plans import serve
from volpanel.schemas import DEMO_REQUEST, LINEAR_MODEL, V1
from volpanel.streaming import scoring


def demo_model(spark):
    coefs = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4, 0.001)], "b0 double, b1 double, b2 double, b3 double, intercept double")
    return serve.model_row(coefs, V1)


REQUESTS = [
    ("flat", json.dumps(DEMO_REQUEST)),
    ("nested", json.dumps({"features": DEMO_REQUEST})),
    ("body_text", json.dumps({"body": json.dumps(DEMO_REQUEST)})),
    ("numeric_strings", json.dumps({k: str(v) for k, v in DEMO_REQUEST.items()})),
    ("missing", json.dumps({k: v for k, v in DEMO_REQUEST.items() if k != "vol_30"})),
    ("null_value", json.dumps({**DEMO_REQUEST, "vol_5": None})),
    ("text_value", json.dumps({**DEMO_REQUEST, "vol_5": "abc"})),
    ("malformed", "{not json"),
]


def test_request_shapes(spark):
    req = spark.createDataFrame(REQUESTS, "name string, request string")
    out = {r["name"]: r for r in serve.score_requests(req, demo_model(spark)).collect()}
    daily = 0.001 + 0.1 * 0.01 + 0.2 * 0.015 + 0.3 * 0.014 + 0.4 * 0.013
    for n in ("flat", "nested", "body_text", "numeric_strings"):
        assert out[n]["statusCode"] == 200
        assert out[n]["pred_daily_vol"] == round(daily, 6) == 0.0144
        assert out[n]["pred_annual_pct"] == round(daily * math.sqrt(252) * 100, 1) == 22.9
        assert json.loads(out[n]["body"]) == {"pred_daily_vol": 0.0144, "pred_annual_pct": 22.9}
    assert out["missing"]["statusCode"] == 400
    assert out["missing"]["error"] == "missing features: ['vol_30']"
    for n in ("null_value", "text_value", "malformed"):
        assert out[n]["statusCode"] == 400 and out[n]["error"].startswith("bad input")


def test_text_behind_the_object_is_rejected(spark):
    demo = json.dumps(DEMO_REQUEST)
    bad = [demo + ',"x":1', demo + ',"x":{"b":2}', demo + ',"v":' + demo, demo + ' {}', demo + "]", "[" + demo + "]", '"a"', "1", "", "null", '{"a":1},"x":1']
    good = [" " + demo + "\n", json.dumps({**DEMO_REQUEST, "v": 1}), json.dumps({"body": {"features": DEMO_REQUEST}}), json.dumps({"body": json.dumps({"features": DEMO_REQUEST, "v": {}})})]
    inner = [json.dumps({"body": b}) for b in bad if b not in ("", "null")]
    req = spark.createDataFrame([(r,) for r in bad + good + inner], "request string")
    out = {r["request"]: r["statusCode"] for r in serve.score_requests(req, demo_model(spark)).collect()}
    assert [out[r] for r in good] == [200] * len(good)
    assert [r for r in bad + inner if out[r] != 400] == []


def test_model_json_round_trip_and_self_check(spark):
    m = demo_model(spark)
    path = tempfile.mkdtemp(prefix="volpanel-model-", dir="/tmp") + "/model"
    serve.export_linear(m, path)
    back = serve.read_linear(spark, path)
    r = back.first()
    assert r["features"] == V1 and r["coef"] == [0.1, 0.2, 0.3, 0.4] and r["target_horizon_days"] == 5
    pred = serve.check_export(back, DEMO_REQUEST).first()["pred"]
    assert abs(pred - 0.0144) < 1e-12


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="volpanel-req-", dir="/tmp")
    with open(f"{d}/part-0.json", "w") as fh:
        fh.write("\n".join(r for _, r in REQUESTS) + "\n")
    out = tempfile.mkdtemp(prefix="volpanel-resp-", dir="/tmp")
    model = demo_model(spark)
    qry = scoring.start_scoring(spark, d, model, out + "/data", out + "/ckpt")
    qry.awaitTermination(120)
    streamed = spark.read.parquet(out + "/data").select("request", "statusCode", "body")
    batch = serve.score_requests(scoring.read_request_batch(spark, d), model).select("request", "statusCode", "body")
    assert streamed.count() == len(REQUESTS)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_log_space_model_is_exponentiated(spark):
    coefs = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, math.log(0.02))], "b0 double, b1 double, b2 double, b3 double, intercept double")
    m = serve.model_row(coefs, V1, log_space=True)
    req = spark.createDataFrame([(json.dumps(DEMO_REQUEST),)], "request string")
    r = serve.score_requests(req, m).first()
    assert r["pred_daily_vol"] == 0.02


def test_finalize_bundle_round_trip_with_fallback(spark):
    from helpers import SF001
    from volpanel.plans import queries as q
    from volpanel.plans.finalize import finalize_and_save
    from volpanel.sources.models import load_meta, load_model

    path = tempfile.mkdtemp(prefix="volpanel-bundle-", dir="/tmp") + "/bundle"
    finalize_and_save(q.clean_panel(spark, SF001), path)
    m = load_model(spark, ["/tmp/volpanel-does-not-exist", path]).first()
    assert m["features"] == V1 and len(m["coef"]) == 4
    dm = m["documented_metrics"]
    assert dm["method"] == "walk-forward, 4 out-of-sample folds" and len(dm["fold_RMSEs"]) == 4
    meta = load_meta(spark, path).first()
    assert meta["n_rows"] == 4984 and meta["n_tickers"] == 10
    assert spark.read.parquet(path + "/tickers").count() == 10


def test_malformed_requests_are_rejected(spark):
    model = spark.createDataFrame([(["a"], [2.0], 1.0, 5, False, None)], LINEAR_MODEL)
    texts = {
        '{"a":1}': 200, '{"a":1} x': 400, '{"a":1}{"a":2}': 400, '{"a":"1.5d"}': 400, '{"a":"1.5f"}': 400, '{"a":"1e1"}': 200, '{"a":" 2 "}': 200,
        '{"features":{"a":1}}': 200, '{"body":"{\\"a\\":1}"}': 200, '{"body":"{\\"a\\":1} x"}': 400, '{"b":1}': 400, "": 400, "[1]": 400, '1, "z": 2': 400, '{"a":null}': 400,
    }
    df = spark.createDataFrame([(t,) for t in texts], "request string")
    assert {r["request"]: r["statusCode"] for r in serve.score_requests(df, model).collect()} == texts
