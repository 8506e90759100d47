"""Golden verdicts on the two sample inputs (FIXTURES.md section 2)."""

import os

from pyspark.sql import functions as F

from rowlint import Pipeline, derive_rules
from rowlint.sources import read_csv
from rowlint.specs import metadata_frame, spec_path


def verdict_strings(run, ids, key="id"):
    rows = run.flat([key]).collect()
    return {int(r[key]): "".join(r[i][0] for i in ids) for r in rows}


def test_sample1_simple_suite(customers):
    run = Pipeline(spec_path("email_standardize")).compile(customers)
    got = verdict_strings(run, ["rule_1", "rule_2", "rule_3"])
    assert got == {1: "PPP", 2: "PPP", 3: "PFP", 4: "PFF", 5: "FFF"}
    emails = {int(r.id): r.email for r in run.annotated().collect()}
    assert emails[3] == "bob.jones@example.com" and emails[5] is None


def test_sample2_complex_suite(customers_large):
    ids = ["dq_email_not_null", "dq_date_format", "dq_age_legal", "dq_age_max",
           "dq_country_valid", "dq_email_valid", "dq_name_len"]
    run = Pipeline(spec_path("customers_complex")).compile(customers_large)
    assert run.rule_ids == ids
    got = verdict_strings(run, ids)
    assert got == {1: "PPPPPPP", 2: "PPFPPPP", 3: "PFPPPPP", 4: "PPPPPFP",
                   5: "FPPPPFP", 6: "PPPFFPP", 7: "PPPPPPF", 8: "PPPPPPP"}


def test_sample3_generated_suite(spark, customers_large):
    ids = ["dq_id_not_null", "dq_email_regex", "dq_signup_date_regex", "dq_name_len", "dq_email_len",
           "dq_age_min", "dq_age_max", "dq_country_valid_set", "dq_country_len"]
    suite = Pipeline.from_rule_table(derive_rules(metadata_frame(spark)))
    run = suite.compile(customers_large)
    assert run.rule_ids == ids
    got = verdict_strings(run, ids)
    assert got == {1: "PPPPPPPPF", 2: "PPPPPFPPP", 3: "PFFPPPPPP", 4: "PFPPPPPPP",
                   5: "PFPPFPPPP", 6: "PPPPPPFFP", 7: "PPPPPPPPF", 8: "PPPPPPPPF"}


def test_csv_scan_defaults(spark, tmp_path):
    p = tmp_path / "customers.csv"
    p.write_text("id,name,email\n1,John Doe,John.Doe@Example.com\n3,Bob Jones,  Bob.Jones@Example.com \n5,Charlie Black,\n")
    df = read_csv(spark, str(p))
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3
    rows = {r.id: r.email for r in df.collect()}
    assert rows["3"] == "  Bob.Jones@Example.com " and rows["5"] is None


def test_map_column_shape(customers):
    out = Pipeline(spec_path("email_standardize")).run(customers)
    assert out.columns == ["id", "name", "email", "_dq_results"]
    t = out.schema["_dq_results"].dataType
    assert t.simpleString() == "map<string,string>" and not t.valueContainsNull
    keys = out.select(F.map_keys("_dq_results").alias("k")).first().k
    assert keys == ["rule_1", "rule_2", "rule_3"]  # rule order (S17)
