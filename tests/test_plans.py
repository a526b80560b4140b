"""Plan-shape guards for the scale properties the operators rely on."""

import re

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = se.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_has_partial_group_limit(spark):
    assert re.search(r"WindowGroupLimit .*Partial", _plan(spark, "top_referrers"))


def test_counts_are_partial_aggregates(spark):
    for name in ("requests_by_agent", "requests_keyed_latest", "word_count", "sessions"):
        assert "partial_" in _plan(spark, name), name


def test_scans_read_only_needed_columns(spark):
    p = _plan(spark, "word_count")
    assert "ReadSchema: struct<text:string>" in p
    p = _plan(spark, "event_type_10s")
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string>", p)


def test_no_python_in_log_and_text_queries(spark):
    for name in ("log_entries", "top_urls_strict", "sessions", "session_running", "word_count", "kfold"):
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", _plan(spark, name)), name


def test_regex_runs_once_per_line(spark):
    p = _plan(spark, "log_entries")
    assert p.count("regexp_replace(") == 1 and "RLike" not in p and "rlike(" not in p.lower()


def test_holdout_ranks_only_first_rows_per_user(spark):
    from logweave.operators import splits
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey")
    df = splits.user_holdout(o, "o_custkey", ["o_orderkey"], 11, 20)
    df.write.format("noop").mode("overwrite").save()
    assert re.search(r"WindowGroupLimit .*row_number\(\), 20, Partial", df._jdf.queryExecution().executedPlan().toString())
