"""Properties over generated rows and specs (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowlint import Pipeline

TEXT = st.one_of(st.none(), st.text(alphabet=" aAbB1.@-é", max_size=8))
ROWS = st.lists(st.tuples(TEXT, TEXT), min_size=0, max_size=12)

CHECK = st.one_of(
    st.just({"type": "check_not_null"}),
    st.sampled_from(["^a", "b$", "@", "[0-9]"]).map(lambda p: {"type": "check_regex", "pattern": p}),
    st.integers(-2, 5).map(lambda v: {"type": "check_min", "value": v}),
    st.integers(-2, 5).map(lambda v: {"type": "check_max", "value": v}),
    st.lists(st.sampled_from(["a", "A", "b", " a"]), max_size=3).map(lambda v: {"type": "check_in_set", "values": v}),
    st.tuples(st.integers(0, 3), st.integers(3, 8)).map(lambda t: {"type": "check_length", "min_len": t[0], "max_len": t[1]}),
)
CLEAN = st.sampled_from(["clean_trim", "clean_lowercase", "clean_uppercase"])


def build(checks1, cleans, checks2):
    def dq(name, checks, base):
        return {"name": name, "type": "dq", "rules": [
            dict(c, id=f"{name}{i}", column=col) for i, (c, col) in enumerate(checks, start=base)]}

    return {"stages": [
        dq("a", checks1, 0),
        {"name": "c", "type": "cleanse", "rules": [{"type": t, "column": "x"} for t in cleans]},
        dq("b", checks2, 100),
    ]}


SPEC = st.tuples(
    st.lists(st.tuples(CHECK, st.sampled_from(["x", "y"])), min_size=1, max_size=4),
    st.lists(CLEAN, min_size=1, max_size=3),
    st.lists(st.tuples(CHECK, st.sampled_from(["x", "y"])), min_size=0, max_size=3),
)

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(rows=ROWS, parts=SPEC)
def test_rows_kept_keys_complete_untouched_columns_unchanged(spark, rows, parts):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "k int, x string, y string")
    p = Pipeline(build(*parts))
    out = p.run(df).orderBy("k").collect()
    assert len(out) == len(rows)
    for r, (x, y) in zip(out, rows):
        assert r.y == y  # never cleansed
        assert sorted(r._dq_results) == sorted(p.rule_ids)
        assert set(r._dq_results.values()) <= {"PASS", "FAIL"}


@settings(**SETTINGS)
@given(rows=ROWS, parts=SPEC)
def test_chaining_two_halves_equals_one_run(spark, rows, parts):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "k int, x string, y string")
    spec = build(*parts)
    whole = Pipeline(spec).run(df)
    first = Pipeline({"stages": spec["stages"][:2]}).run(df)
    second = Pipeline({"stages": spec["stages"][2:]}).run(first)
    a = {r.k: (r.x, r._dq_results) for r in whole.collect()}
    b = {r.k: (r.x, r._dq_results) for r in second.collect()}
    assert a == b


@settings(**SETTINGS)
@given(rows=ROWS, cleans=st.lists(CLEAN, min_size=1, max_size=1))
def test_cleansing_twice_equals_once(spark, rows, cleans):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "k int, x string, y string")
    stage = {"name": "c", "type": "cleanse", "rules": [{"type": cleans[0], "column": "x"}]}
    once = Pipeline({"stages": [stage]}).run(df)
    twice = Pipeline({"stages": [stage, dict(stage, name="d")]}).run(df)
    assert sorted(once.collect()) == sorted(twice.collect())


@settings(**SETTINGS)
@given(rows=ROWS, parts=SPEC)
def test_summary_agrees_with_map_and_exploded(spark, rows, parts):
    from rowlint import report

    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "k int, x string, y string")
    run = Pipeline(build(*parts)).compile(df)
    a = sorted(tuple(r) for r in run.summary().collect())
    b = sorted(tuple(r) for r in report.summary(run.annotated()).collect())
    if rows:
        assert a == b
    n_fail = run.exploded(["k"]).where(F.col("status") == "FAIL").count()
    assert n_fail == sum(r.n_fail for r in run.summary().collect())
