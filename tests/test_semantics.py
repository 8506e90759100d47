
import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowlint import Pipeline, SpecError, SpecWarning


def one(rule, stage="dq"):
    return Pipeline({"stages": [{"name": "s", "type": stage, "rules": [rule]}]})


def statuses(spark, rule, rows, schema="v string"):
    df = spark.createDataFrame(rows, schema)
    rid = rule.setdefault("id", "r")
    return [r[rid] for r in one(rule).compile(df).flat([]).collect()]


CHECKS = [
    {"type": "check_not_null"},
    {"type": "check_regex", "pattern": ".*"},
    {"type": "check_min", "value": 0},
    {"type": "check_max", "value": 0},
    {"type": "check_range", "min": 0, "max": 1},
    {"type": "check_in_set", "values": ["a"]},
    {"type": "check_length", "min_len": 0, "max_len": 5},
]


@pytest.mark.parametrize("rule", CHECKS, ids=[c["type"] for c in CHECKS])
def test_s1_null_fails_every_check(spark, rule):
    assert statuses(spark, dict(rule, column="v"), [(None,)]) == ["FAIL"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_s2_non_numeric_text_fails_without_abort(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = statuses(spark, {"type": "check_min", "column": "v", "value": 18}, [("abc",), ("20",), ("17",)])
        assert got == ["FAIL", "PASS", "FAIL"]
        got = statuses(spark, {"type": "check_max", "column": "v", "value": 18}, [("n/a",), ("18",)])
        assert got == ["FAIL", "PASS"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_s3_text_compares_as_double_numbers_natively(spark):
    assert statuses(spark, {"type": "check_max", "column": "v", "value": 0.1}, [("0.1",)]) == ["PASS"]
    assert statuses(spark, {"type": "check_min", "column": "v", "value": 0.7}, [("0.7",)]) == ["PASS"]
    assert statuses(spark, {"type": "check_max", "column": "v", "value": 16777216}, [("16777217",)]) == ["FAIL"]
    got = statuses(spark, {"type": "check_max", "column": "v", "value": 16777216}, [(16777217,), (16777216,)], "v long")
    assert got == ["FAIL", "PASS"]


def test_s4_nan_and_infinity(spark):
    assert statuses(spark, {"type": "check_min", "column": "v", "value": 0}, [("NaN",), ("Infinity",)]) == ["PASS", "PASS"]
    assert statuses(spark, {"type": "check_max", "column": "v", "value": 0}, [("NaN",)]) == ["FAIL"]


def test_s5_regex_is_an_unanchored_find(spark):
    rows = [("xx abc yy",), ("abc\n",), ("ABC",)]
    assert statuses(spark, {"type": "check_regex", "column": "v", "pattern": "abc"}, rows) == ["PASS", "PASS", "FAIL"]
    assert statuses(spark, {"type": "check_regex", "column": "v", "pattern": "abc$"}, rows) == ["FAIL", "PASS", "FAIL"]
    assert statuses(spark, {"type": "check_regex", "column": "v", "pattern": ""}, rows) == ["PASS"] * 3


def test_s5_bad_pattern_caught_by_validation(spark):
    p = one({"id": "r", "type": "check_regex", "column": "v", "pattern": "a(b"})
    problems = p.check_patterns(spark)
    assert len(problems) == 1 and "a(b" in problems[0]
    assert one({"id": "r", "type": "check_regex", "column": "v", "pattern": r"\p{Alpha}+"}).check_patterns(spark) == []


def test_s6_set_is_case_sensitive_empty_fails_null_never_matches(spark):
    rows = [("usa",), ("USA",), (None,)]
    assert statuses(spark, {"type": "check_in_set", "column": "v", "values": ["usa"]}, rows) == ["PASS", "FAIL", "FAIL"]
    assert statuses(spark, {"type": "check_in_set", "column": "v", "values": []}, rows) == ["FAIL"] * 3
    assert statuses(spark, {"type": "check_in_set", "column": "v", "values": [None, "usa"]}, rows) == ["PASS", "FAIL", "FAIL"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_s7_mixed_type_sets_never_abort(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", SpecWarning)
            # text column: literals become text, so 1 matches '1' but not '01'
            got = statuses(spark, {"type": "check_in_set", "column": "v", "values": [1, "usa", False]},
                           [("1",), ("01",), ("abc",), ("false",)])
            assert got == ["PASS", "FAIL", "FAIL", "PASS"]
            # int column: literals that do not fit are dropped
            got = statuses(spark, {"type": "check_in_set", "column": "v", "values": ["1", "usa"]}, [(1,), (2,)], "v int")
            assert got == ["PASS", "FAIL"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_s8_length_code_points_bytes_and_open_bounds(spark):
    assert statuses(spark, {"type": "check_length", "column": "v", "min_len": 2, "max_len": 2}, [("😀é",)]) == ["PASS"]
    assert statuses(spark, {"type": "check_length", "column": "v", "min_len": 2, "max_len": 2}, [(bytearray(b"ab"),)], "v binary") == ["PASS"]
    assert statuses(spark, {"type": "check_length", "column": "v", "max_len": 3}, [(123,), (1234,)], "v int") == ["PASS", "FAIL"]
    assert statuses(spark, {"type": "check_length", "column": "v", "min_len": 3}, [("ab",), ("abcdef",)]) == ["FAIL", "PASS"]


def test_s9_duplicate_rule_id_rejected():
    spec = {"stages": [{"name": "a", "type": "dq", "rules": [
        {"id": "x", "type": "check_not_null", "column": "v"},
        {"id": "x", "type": "check_not_null", "column": "w"}]}]}
    with pytest.raises(SpecError, match="duplicate rule id 'x'"):
        Pipeline(spec)


def test_s10_unknown_rule_and_stage_warn_and_skip(spark):
    spec = {"stages": [
        {"name": "a", "type": "dq", "rules": [{"id": "x", "type": "check_not_null", "column": "v"},
                                              {"id": "y", "type": "check_nope", "column": "v"}]},
        {"name": "b", "type": "audit", "rules": []}]}
    with pytest.warns(SpecWarning) as rec:
        p = Pipeline(spec)
    assert len(rec) == 2 and p.rule_ids == ["x"]
    with pytest.raises(SpecError) as e:
        Pipeline(spec, on_unknown="error")
    assert len(e.value.problems) == 2


def test_s11_missing_keys_reported_together():
    spec = {"stages": [{"type": "dq", "rules": [{"type": "check_regex"}, {"column": "v"}]},
                       {"name": "c", "rules": []}]}
    with pytest.raises(SpecError) as e:
        Pipeline(spec)
    text = "\n".join(e.value.problems)
    for part in ["missing 'name'", "missing 'column'", "missing parameter 'pattern'", "missing 'type'"]:
        assert part in text
    assert len(e.value.problems) >= 5


def test_s12_unexpected_parameter_and_cleanse_id(spark):
    with pytest.raises(SpecError, match="unexpected parameter 'foo'"):
        one({"id": "r", "type": "check_not_null", "column": "v", "foo": 1})
    p = one({"id": "c1", "type": "clean_trim", "column": "v"}, stage="cleanse")
    assert p.spec.stages[0].rules[0].id == "c1"


def test_s13_ids_become_text(spark):
    p = one({"id": 1, "type": "check_not_null", "column": "v"})
    assert p.rule_ids == ["1"]
    df = spark.createDataFrame([("a",)], "v string")
    assert p.run(df).schema["_dq_results"].dataType.simpleString() == "map<string,string>"


def test_s14_incoming_results_are_kept(spark):
    df = spark.createDataFrame([("a", {"old": "PASS", "r": "PASS"}), (None, None)], "v string, _dq_results map<string,string>")
    out = one({"id": "r", "type": "check_not_null", "column": "v"}).run(df)
    assert out.columns == ["v", "_dq_results"]
    got = [r._dq_results for r in out.collect()]
    assert got == [{"old": "PASS", "r": "PASS"}, {"r": "FAIL"}]
    bad = spark.createDataFrame([("a", "x")], "v string, _dq_results string")
    with pytest.raises(SpecError, match="not map<string,string>"):
        one({"id": "r", "type": "check_not_null", "column": "v"}).run(bad)


def test_s15_cleanse_struct_field_in_place(spark):
    df = spark.createDataFrame([(("  A ", 1),)], "s struct<a: string, b: int>")
    out = one({"type": "clean_trim", "column": "s.a"}, stage="cleanse").run(df)
    assert out.columns == ["s"] and out.first().s.a == "A" and out.first().s.b == 1
    arr = spark.createDataFrame([([("a",)],)], "xs array<struct<a: string>>")
    with pytest.raises(SpecError, match="not a struct"):
        one({"type": "clean_trim", "column": "xs.a"}, stage="cleanse").run(arr)


def test_s16_schema_spelling_kept(spark):
    df = spark.createDataFrame([(" A ",)], "email string")
    out = one({"type": "clean_trim", "column": "EMAIL"}, stage="cleanse").run(df)
    assert out.columns == ["email"] and out.first().email == "A"


def test_s17_map_keys_in_rule_order(spark):
    rules = [{"id": f"r{i}", "type": "check_not_null", "column": "v"} for i in (3, 1, 2)]
    df = spark.createDataFrame([("a",)], "v string")
    out = Pipeline({"stages": [{"name": "s", "type": "dq", "rules": rules}]}).run(df)
    # read the order in Spark: a Python dict from a collected map may reorder
    assert out.select(F.map_keys("_dq_results").alias("k")).first().k == ["r3", "r1", "r2"]


def test_s18_dates_under_min_max_rejected_at_compile(spark):
    df = spark.sql("SELECT date'2024-01-01' AS d, timestamp_ntz'2024-01-01 00:00:00' AS t")
    for c in ("d", "t"):
        with pytest.raises(SpecError, match="compares numbers"):
            one({"id": "r", "type": "check_min", "column": c, "value": 1}).compile(df)


def test_s19_lowercase_beyond_ascii(spark):
    df = spark.createDataFrame([("İ",), ("ΣΑΣ",)], "v string")
    out = one({"type": "clean_lowercase", "column": "v"}, stage="cleanse").run(df)
    got = [r.v for r in out.collect()]
    assert len(got[0]) == 2 and got[1] == "σας"


def test_cleanse_type_drift_is_reported(spark):
    df = spark.createDataFrame([(5,)], "n int")
    with pytest.warns(SpecWarning, match="from int into string"):
        out = one({"type": "clean_trim", "column": "n"}, stage="cleanse").run(df)
    assert out.schema["n"].dataType.simpleString() == "string"


def test_missing_column_fails_before_data_moves(spark):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(SpecError, match="not found"):
        one({"id": "r", "type": "check_not_null", "column": "nope"}).compile(df)


def test_summary_with_awkward_rule_ids(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    ids = ["it's", "back\\\\slash", "dotted.id", "émoji😀"]
    p = Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [
        {"id": i, "type": "check_not_null", "column": "v"} for i in ids]}]})
    got = {r.rule_id: (r.n_pass, r.n_fail, r.n_rows) for r in p.compile(df).summary().collect()}
    assert got == {i: (1, 1, 2) for i in ids}
    p2 = Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [
        {"id": i, "type": "check_not_null", "column": "v"} for i in ids[1:]]}]})
    got = {r.rule_id for r in p2.compile(df).summary().collect()}
    assert got == set(ids[1:])


def test_s5_bad_pattern_fails_the_plan_not_a_task(spark):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(SpecError, match="invalid regex"):
        one({"id": "r", "type": "check_regex", "column": "v", "pattern": "[a-"}).compile(df)
