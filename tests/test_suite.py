"""Suite derivation from column metadata (G1-G9)."""

from pyspark.sql import functions as F

from rowlint import Pipeline, derive_rules, suite_pipeline
from rowlint.specs import METADATA_SCHEMA, metadata_frame, metadata_rows

# The three-stage suite the customer metadata must yield.
EXPECTED = {"stages": [
    {"name": "Ingestion Quality", "type": "dq", "rules": [
        {"id": "dq_id_not_null", "type": "check_not_null", "column": "id"},
        {"id": "dq_email_regex", "type": "check_regex", "column": "email",
         "pattern": "^[a-z0-9_.+-]+@[a-z0-9-]+\\.[a-z0-9-.]+$"},
        {"id": "dq_signup_date_regex", "type": "check_regex", "column": "signup_date",
         "pattern": "^\\d{4}-\\d{2}-\\d{2}$"}]},
    {"name": "Standardization", "type": "cleanse", "rules": [
        {"type": "clean_trim", "column": "name"},
        {"type": "clean_trim", "column": "email"},
        {"type": "clean_lowercase", "column": "email"},
        {"type": "clean_trim", "column": "country"},
        {"type": "clean_lowercase", "column": "country"}]},
    {"name": "Business Logic Verification", "type": "dq", "rules": [
        {"id": "dq_name_len", "type": "check_length", "column": "name", "min_len": 0, "max_len": 50},
        {"id": "dq_email_len", "type": "check_length", "column": "email", "min_len": 0, "max_len": 100},
        {"id": "dq_age_min", "type": "check_min", "column": "age", "value": 18},
        {"id": "dq_age_max", "type": "check_max", "column": "age", "value": 120},
        {"id": "dq_country_valid_set", "type": "check_in_set", "column": "country",
         "values": ["usa", "uk", "ca", "au", "de"]},
        {"id": "dq_country_len", "type": "check_length", "column": "country", "min_len": 0, "max_len": 2}]},
]}


def test_derived_suite_matches_expected(spark):
    p = Pipeline.from_rule_table(derive_rules(metadata_frame(spark)))
    assert p.spec.to_dict() == EXPECTED


def test_rule_table_shape(spark):
    rules = derive_rules(metadata_frame(spark))
    assert rules.count() == 14
    assert rules.where(F.col("type") == "check_in_set").count() == 1
    assert rules.where(F.col("stage_type") == "cleanse").count() == 5


def test_empty_stages_absent_and_many_tables(spark):
    rows = []
    for r in metadata_rows():
        rows.append(dict(r, table="customers"))
    rows.append({"table": "codes", "ordinal": 1, "column": "code", "type": "INTEGER", "nullable": False,
                 "length": None, "constraints": {"regex": None, "min": None, "max": None, "enum": None}})
    meta = spark.createDataFrame(rows, METADATA_SCHEMA + ", table string")
    codes = suite_pipeline(meta, table="codes")
    assert [s.name for s in codes.spec.stages] == ["Ingestion Quality"]
    assert codes.rule_ids == ["dq_code_not_null"]
    assert suite_pipeline(meta, table="customers").spec.to_dict() == EXPECTED


def test_name_heuristic_is_case_sensitive_and_string_has_no_length_rule(spark):
    rows = [
        {"ordinal": 1, "column": "EMAIL", "type": "STRING", "nullable": True, "length": 10,
         "constraints": {"regex": None, "min": 0.0, "max": None, "enum": None}},
    ]
    p = Pipeline.from_rule_table(derive_rules(spark.createDataFrame(rows, METADATA_SCHEMA)))
    d = p.spec.to_dict()
    assert [r["type"] for r in d["stages"][0]["rules"]] == ["clean_trim"]
    assert [r["id"] for r in d["stages"][1]["rules"]] == ["dq_EMAIL_min"]  # a bound of 0 counts


def test_mixed_tables_and_missing_positions_are_refused(spark):
    import pytest

    from rowlint import SpecError

    rows = [dict(r, table=t) for t in ("a", "b") for r in metadata_rows()]
    meta = spark.createDataFrame(rows, METADATA_SCHEMA + ", table string")
    with pytest.raises(SpecError):
        suite_pipeline(meta)
    with pytest.raises(ValueError):
        derive_rules(meta.drop("ordinal"))


def test_long_bounds_stay_exact(spark):
    schema = METADATA_SCHEMA.replace("min: double, max: double", "min: bigint, max: bigint")
    meta = spark.createDataFrame([{"ordinal": 1, "column": "v", "type": "BIGINT", "nullable": True, "length": None,
                                   "constraints": {"regex": None, "min": None, "max": 9007199254740992, "enum": None}}], schema)
    df = spark.createDataFrame([(9007199254740993,), (9007199254740992,)], "v long")
    assert [r.dq_v_max for r in suite_pipeline(meta).compile(df).flat(["v"]).collect()] == ["FAIL", "PASS"]


def test_profile_of_an_empty_table(spark):
    from rowlint.operators import profile_columns

    df = spark.createDataFrame([], "a long, b string, c double")
    got = {r["column"]: r for r in profile_columns(df).collect()}
    assert got["a"]["constraints"]["min"] is None and got["b"]["length"] is None and not got["c"]["nullable"]
    assert suite_pipeline(profile_columns(df)).rule_ids == ["dq_a_not_null", "dq_b_not_null", "dq_c_not_null"]
