import pytest
from pyspark.sql import functions as F

from helpers import SF01, day
from volpanel.operators import splits
from volpanel.plans import queries as q


def dates_df(spark, idx):
    return spark.createDataFrame([(day(i),) for i in idx], "date date")


def fold_sizes(df):
    return [r["rows"] for r in splits.fold_profile(splits.assign_folds(df)).orderBy("fold").collect()]


def test_seven_dates_not_ntile(spark):
    assert fold_sizes(dates_df(spark, range(7))) == [1, 1, 2, 1, 2]


def test_four_dates_raise(spark):
    with pytest.raises(Exception, match="bin edges must be unique"):
        splits.assign_folds(dates_df(spark, range(4))).collect()


def test_row_weighted_cutoffs(spark):
    df = dates_df(spark, [0] * 7 + [1, 2, 3])
    c = splits.cutoff_dates(df, [0.6, 0.8]).first()
    assert c["c0"] == day(0)
    assert c["c1"] == day(2)


def test_split_three_half_open(spark):
    df = dates_df(spark, range(10))
    s = {r["date"]: r["set"] for r in splits.split_three(df).collect()}
    assert [s[day(i)] for i in range(10)] == ["train"] * 6 + ["val"] * 2 + ["test"] * 2


def test_folds_partition_rows_and_order(spark):
    clean = q.clean_panel(spark, SF01)
    folded = splits.assign_folds(clean)
    prof = splits.fold_profile(folded).orderBy("fold").collect()
    assert [r["rows"] for r in prof] == [9514, 10224, 10245, 10028, 9796]
    assert sum(r["rows"] for r in prof) == clean.count() == 49807
    for a, b in zip(prof, prof[1:]):
        assert a["end"] < b["start"]
    cal = splits.fold_calendar(clean).orderBy("date").collect()
    firsts = [i for i in range(1, len(cal)) if cal[i]["fold"] != cal[i - 1]["fold"]]
    assert firsts == [475, 951, 1427, 1903]


def test_train_before_test(spark):
    s = splits.split_two(q.clean_panel(spark, SF01))
    r = s.groupBy("set").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()
    d = {x["set"]: x for x in r}
    assert d["train"]["hi"] < d["test"]["lo"]
