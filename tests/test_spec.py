"""Spec loading, validation and editor-exported specs."""

import pytest
import yaml

from rowlint import Pipeline, PipelineSpec, SpecError
from rowlint.specs import spec_path


def test_yaml_file_text_and_dict_agree():
    a = Pipeline(spec_path("customers_complex"))
    with open(spec_path("customers_complex")) as f:
        text = f.read()
    b = Pipeline.from_yaml(text)
    c = Pipeline(yaml.safe_load(text))
    assert a.spec == b.spec == c.spec
    assert len(a.spec.stages) == 3 and a.rule_ids[0] == "dq_email_not_null"


def test_to_yaml_round_trip():
    p = Pipeline(spec_path("email_standardize"))
    assert PipelineSpec.from_yaml(p.spec.to_yaml()) == p.spec


def test_single_stage_users_suite_loads():
    p = Pipeline(spec_path("users_generated"))
    assert p.rule_ids == ["auto_nn_users_id", "auto_nn_users_username", "auto_len_users_username",
                          "auto_len_users_email", "auto_len_users_country_code"]


def test_editor_rules_without_id_get_generated_ids():
    spec = {"stages": [{"name": "DQ", "type": "dq", "rules": [
        {"type": "check_not_null", "column": "email"},
        {"type": "check_regex", "column": "email", "pattern": "@"}]}]}
    assert Pipeline(spec).rule_ids == ["1_1_check_not_null_email", "1_2_check_regex_email"]


def test_editor_length_aliases_and_lost_minimum():
    spec = {"stages": [{"name": "DQ", "type": "dq", "rules": [
        {"id": "a", "type": "check_length", "column": "n", "min": 1, "max": 10},
        {"id": "b", "type": "check_length", "column": "n", "max_len": 10}]}]}
    rules = Pipeline(spec).spec.stages[0].rules
    assert rules[0].kwargs() == {"min_len": 1, "max_len": 10}
    assert rules[1].kwargs() == {"max_len": 10}


def test_editor_values_are_text_and_numbers_may_be_text():
    spec = {"stages": [{"name": "DQ", "type": "dq", "rules": [
        {"id": "a", "type": "check_in_set", "column": "c", "values": ["us", "uk"]},
        {"id": "b", "type": "check_min", "column": "n", "value": "18"}]}]}
    rules = Pipeline(spec).spec.stages[0].rules
    assert rules[1].kwargs() == {"value": 18}


def test_editor_empty_column_and_bad_numbers_rejected():
    spec = {"stages": [{"name": "DQ", "type": "dq", "rules": [
        {"id": "a", "type": "check_not_null", "column": ""},
        {"id": "b", "type": "check_min", "column": "n", "value": "abc"},
        {"id": "c", "type": "check_length", "column": "n", "min_len": 1, "min": 2},
        {"id": "d", "type": "check_range", "column": "n"},
        {"id": "e", "type": "check_length", "column": "n", "min_len": 5, "max_len": 2}]}]}
    with pytest.raises(SpecError) as e:
        Pipeline(spec)
    text = "\n".join(e.value.problems)
    assert "missing 'column'" in text
    assert "must be a number" in text
    assert "both given" in text
    assert "needs min or max" in text
    assert "nothing can pass" in text


def test_not_a_spec():
    with pytest.raises(SpecError):
        Pipeline({"stage": []})
    with pytest.raises(SpecError):
        PipelineSpec.from_yaml("- a\n- b\n")


def test_then_concatenates_and_checks_ids():
    a = Pipeline(spec_path("email_standardize"))
    b = Pipeline({"stages": [{"name": "late", "type": "dq", "rules": [{"id": "late", "type": "check_not_null", "column": "c"}]}]})
    assert a.then(b).rule_ids == ["rule_1", "rule_2", "rule_3", "late"]
    with pytest.raises(SpecError):
        a.then(a)


def test_load_through_spark(spark, tmp_path):
    p = tmp_path / "s.yaml"
    p.write_text(open(spec_path("email_standardize")).read())
    a = Pipeline.load("file://" + str(p), spark=spark)
    assert a.rule_ids == ["rule_1", "rule_2", "rule_3"]


def test_missing_spec_file_is_reported():
    with pytest.raises(FileNotFoundError):
        Pipeline("no/such/spec.yaml")
