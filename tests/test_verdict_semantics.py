"""Sets that must fit exactly, keys under skew, registries, specs of one file."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from rowlint import Param, Pipeline, Registry, SpecError, register_check
from rowlint.functions.registry import DEFAULT_REGISTRY


def one(rule):
    return Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [{"id": "r", **rule}]}]}, on_unknown="error")


def verdicts(df, rule, **kw):
    return [r.r for r in one(rule).compile(df, **kw).flat(["v"]).orderBy("v").collect()]


@pytest.mark.parametrize("kind, rows, values, want", [
    ("int", [1, 2], [1.5, True, "x", 1 << 40], ["FAIL", "FAIL"]),
    ("int", [1, 2], [1.0, "2"], ["PASS", "PASS"]),
    ("tinyint", [1], [257], ["FAIL"]),
    ("double", [1.0, 2.5], ["2.5", 1, False], ["PASS", "PASS"]),
    ("float", [0.1, 0.5], [0.1, 0.5], ["FAIL", "PASS"]),
    ("decimal(10,2)", [1.01, 1.10], [1.009, 1.1, 10 ** 12], ["FAIL", "PASS"]),
    ("boolean", [True], [1, "yes"], ["FAIL"]),
    ("boolean", [True], ["True"], ["PASS"]),
    ("date", [datetime.date(2024, 1, 1)], ["2024", "2024-01"], ["FAIL"]),
    ("date", [datetime.date(2024, 1, 1)], ["2024-01-01"], ["PASS"]),
    ("date", [datetime.date(2024, 1, 1)], [datetime.datetime(2024, 1, 1, 5)], ["FAIL"]),
    ("timestamp", [datetime.datetime(2024, 1, 1, 5)], ["2024", "2024-01-01 05:00:00"], ["PASS"]),
])
@pytest.mark.filterwarnings("ignore")
def test_set_members_must_fit_exactly(spark, kind, rows, values, want):
    df = spark.createDataFrame([(str(v),) for v in rows], "s string").select(F.col("s").cast(kind).alias("v"))
    assert verdicts(df, {"type": "check_in_set", "column": "v", "values": values}) == want


def test_bounds_beyond_64_bits(spark):
    df = spark.createDataFrame([(5,)], "v long")
    assert verdicts(df, {"type": "check_max", "column": "v", "value": 1 << 70}) == ["PASS"]
    assert verdicts(df, {"type": "check_range", "column": "v", "min": -(1 << 80), "max": 4}) == ["FAIL"]
    assert verdicts(df, {"type": "check_in_set", "column": "v", "values": [1 << 64, 5]}) == ["PASS"]
    with pytest.raises(SpecError):
        one({"type": "check_min", "column": "v", "value": 10 ** 40})


def test_reference_keys_must_fit_exactly(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    ref = spark.createDataFrame([(1.5,), (2.0,)], "k double")
    assert verdicts(df, {"type": "check_in_table", "column": "v", "table": "t", "key": "k"}, tables={"t": ref}) == ["FAIL", "PASS"]


def largest_partition(df):
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())


def test_hot_and_null_keys_are_split(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rule = {"type": "check_in_table", "column": "v", "table": "t", "key": "k"}
        ref = spark.range(1000).select(F.col("id").alias("k"))
        for value in (F.lit(7), F.lit(None)):
            rows = spark.range(0, 200000, 1, 8).select("id", F.when(F.col("id") % 3 < 2, value).otherwise(F.col("id") % 2000).cast("long").alias("v"))
            out = one(rule).compile(rows, tables={"t": ref}).flat(["id", "v"])
            got = out.groupBy("r").count().collect()
            want = rows.where("v < 1000").count()
            assert {r["r"]: r["count"] for r in got}["PASS"] == want
            joined = out.select("id", "v", "r")
            assert largest_partition(joined) < 100000
            if value is not None and "7" in str(value):
                joined.collect()
                assert re.search(r"skew=true", joined._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def starts(registry, name="check_starts"):
    @register_check(name, params=[Param("prefix", "str")], registry=registry)
    def check(c, dtype, prefix):
        return c.startswith(prefix)

    return registry


def test_joining_pipelines_merges_their_rule_types(spark):
    a = Pipeline({"stages": [{"name": "a", "type": "dq", "rules": [{"id": "nn", "type": "check_not_null", "column": "v"}]}]})
    mine = starts(DEFAULT_REGISTRY.copy())
    b = Pipeline({"stages": [{"name": "b", "type": "dq", "rules": [{"id": "st", "type": "check_starts", "column": "v", "prefix": "x"}]}]}, registry=mine)
    df = spark.createDataFrame([("xy",)], "v string")
    assert a.then(b).compile(df).flat(["v"]).first().st == "PASS"
    other = starts(DEFAULT_REGISTRY.copy())
    with pytest.raises(ValueError):
        b.then(Pipeline({"stages": []}, registry=other))
    with pytest.raises(SpecError):
        Pipeline(b.spec, registry=Registry()).compile(df)


def test_a_spec_is_one_file(spark, tmp_path):
    text = "stages:\n  - name: s\n    type: dq\n    rules:\n      - {id: %s, type: check_not_null, column: v}\n"
    (tmp_path / "a.yaml").write_text(text % "a")
    assert Pipeline.load(f"{tmp_path}/*.yaml", spark=spark).rule_ids == ["a"]
    (tmp_path / "b.yaml").write_text(text % "b")
    with pytest.raises(SpecError):
        Pipeline.load(f"{tmp_path}/*.yaml", spark=spark)


def test_incoming_map_in_every_report(spark):
    df = spark.createDataFrame([("x", {"old": "PASS", "r": "FAIL"})], "v string, _dq_results map<string,string>")
    rule = {"type": "check_not_null", "column": "v"}
    run = one(rule).compile(df)
    assert [(r.rule_id, r.status) for r in run.exploded().collect()] == [("r", "PASS")]
    assert [r.rule_id for r in run.summary().collect()] == ["r"]
    assert run.annotated().first()["_dq_results"] == {"old": "PASS", "r": "PASS"}
    with pytest.raises(Exception, match="(?i)duplicate"):
        one(rule).compile(df, on_recheck="error").annotated().collect()
