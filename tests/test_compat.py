"""The DataFrame-level compatibility functions give the same verdicts."""

from pyspark.sql import functions as F

from rowlint import compat


def test_chained_calls_match_sample_1(customers):
    df = compat.check_not_null(customers, "email", "rule_1")
    df = compat.check_regex(df, "email", r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$", "rule_2")
    df = compat.clean_trim(df, "email")
    df = compat.clean_lowercase(df, "email")
    df = compat.check_regex(df, "email", r"^[a-z0-9_.+-]+@[a-z0-9-]+\.[a-z0-9-.]+$", "rule_3")
    assert df.columns == ["id", "name", "email", "_dq_results"]
    got = {int(r.id): "".join(r._dq_results[k][0] for k in ("rule_1", "rule_2", "rule_3")) for r in df.collect()}
    assert got == {1: "PPP", 2: "PPP", 3: "PFP", 4: "PFF", 5: "FFF"}
    summary = {r.rule_id: r.n_pass for r in compat.get_dq_summary(df).collect()}
    assert summary == {"rule_1": 4, "rule_2": 2, "rule_3": 3}


def test_numeric_set_length_and_add_result(customers_large):
    df = compat.check_min(customers_large, "age", 18, "age_min")
    df = compat.check_max(df, "age", 120, "age_max")
    df = compat.check_range(df, "age", 18, 120, "age_range")
    df = compat.check_in_set(df, "country", ["USA", "UK"], "country")
    df = compat.check_length(df, "name", 2, 50, "name_len")
    df = compat.add_dq_result(df, "has_id", F.col("id").isNotNull())
    df = compat.clean_uppercase(df, "country")
    rows = {int(r.id): r for r in df.collect()}
    assert rows[2]._dq_results["age_min"] == "FAIL" and rows[6]._dq_results["age_max"] == "FAIL"
    assert rows[6]._dq_results["age_range"] == "FAIL" and rows[1]._dq_results["age_range"] == "PASS"
    assert rows[8]._dq_results["country"] == "FAIL" and rows[8].country == "USA"
    assert rows[7]._dq_results["name_len"] == "FAIL"
    assert all(r._dq_results["has_id"] == "PASS" for r in rows.values())
