"""check_in_table: membership in a reference table, by a distinct-key join."""

import pytest

from rowlint import Pipeline, SpecError


def rule(**kw):
    r = {"id": "ref", "type": "check_in_table", "column": "v", "table": "allowed"}
    r.update(kw)
    return Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [r]}]})


def test_duplicate_reference_keys_never_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "k int, v string")
    allowed = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "v string")
    out = rule().compile(df, tables={"allowed": allowed}).flat(["k"])
    assert sorted((r.k, r.ref) for r in out.collect()) == [(1, "PASS"), (2, "FAIL"), (3, "FAIL"), (4, "PASS")]


def test_key_types_are_aligned_to_the_column(spark):
    df = spark.createDataFrame([(1, 10), (2, 11)], "k int, v bigint")
    allowed = spark.createDataFrame([("10",), ("x",)], "code string")
    out = rule(key="code").compile(df, tables={"allowed": allowed}).flat(["k"])
    assert sorted((r.k, r.ref) for r in out.collect()) == [(1, "PASS"), (2, "FAIL")]


def test_catalog_table_and_snapshot_semantics(spark):
    spark.createDataFrame([("x",)], "v string").createOrReplaceTempView("allowed_codes")
    p = Pipeline({"stages": [
        {"name": "a", "type": "dq", "rules": [{"id": "before", "type": "check_in_table", "column": "v", "table": "allowed_codes"}]},
        {"name": "b", "type": "cleanse", "rules": [{"type": "clean_lowercase", "column": "v"}]},
        {"name": "c", "type": "dq", "rules": [{"id": "after", "type": "check_in_table", "column": "v", "table": "allowed_codes"}]},
    ]})
    df = spark.createDataFrame([(1, "X"), (2, "x")], "k int, v string")
    got = sorted(tuple(r) for r in p.compile(df).flat(["k"]).collect())
    assert got == [(1, "FAIL", "PASS"), (2, "PASS", "PASS")]
    assert p.run(df).columns == ["k", "v", "_dq_results"]


def test_missing_reference_table_is_a_spec_error(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(SpecError, match="no table 'allowed'"):
        rule().compile(df)


def test_broadcast_and_sort_merge_agree(spark):
    import __spark_entry__ as E
    from conftest import SF01

    want = sorted(tuple(r) for r in E.lineitem_references(spark, SF01).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.lineitem_references(spark, SF01)
        import contextlib, io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "SortMergeJoin" in buf.getvalue() and "BroadcastHashJoin" not in buf.getvalue()
        assert sorted(tuple(r) for r in df.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_holding_a_third_of_rows(spark):
    from pyspark.sql import functions as F

    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 50).cast("string"))).alias("v"),
    )
    allowed = spark.createDataFrame([("hot",)] * 5 + [(f"v{i}",) for i in range(0, 50, 2)], "v string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = rule().compile(df, tables={"allowed": allowed}).summary().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want_pass = sum(1 for i in range(n) if i % 3 == 0 or (i % 50) % 2 == 0)
    assert [(r.n_pass, r.n_rows) for r in out] == [(want_pass, n)]
