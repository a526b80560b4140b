
import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def test_folds_disjoint_and_complete(spark):
    folds = se.queries()["kfold"](spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert folds.count() == orders.count() == folds.select("o_orderkey").distinct().count()
    sizes = sorted(r[0] for r in folds.groupBy("fold").count().select("count").collect())
    assert len(sizes) == 5 and sizes[-1] - sizes[0] <= 1


def test_session_lengths_add_up(spark):
    s = se.queries()["sessions"](spark, SF)
    assert s.agg({"sessionLength": "sum"}).first()[0] == spark.read.parquet(f"{SF}/events.parquet").count()


def test_running_max_and_totals_non_decreasing(spark):
    r = se.queries()["text_length_running"](spark, SF).orderBy("source").collect()
    for a, b in zip(r, r[1:]):
        assert b["max_length"] >= a["max_length"] and b["total_rows"] > a["total_rows"]
    assert r[-1]["total_rows"] == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_alarm_states_follow_quiet_period(spark):
    from datetime import timedelta
    a = se.queries()["error_ratio_alarms"](spark, SF).where("state = 'fired'").orderBy("window_end").collect()
    for x, y in zip(a, a[1:]):
        assert y["window_end"] - x["window_end"] > timedelta(minutes=30)
