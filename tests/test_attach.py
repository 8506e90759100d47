"""Rules that need more than the row: unique keys, intervals of a table, sequences."""

import contextlib
import datetime
import io
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rowlint import Pipeline, SpecError


def one(rule):
    return Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [{"id": "r", **rule}]}]}, on_unknown="error")


def got(df, rule, key="k", **kw):
    rows = one(rule).compile(df, **kw).flat([key]).collect()
    out = {r[key]: r["r"] == "PASS" for r in rows}
    assert len(out) == len(rows)
    return out


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def settings(spark, **kw):
    kw = {k.replace("__", "."): v for k, v in kw.items()}
    old = {k: spark.conf.get(k, None) for k in kw}
    for k, v in kw.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


MERGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def largest_partition(df):
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())


# -- unique --------------------------------------------------------------------
ROWS = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 1.0), (4, None, 1.0), (5, None, None), (6, "", 3.0), (7, "c", None), (8, "c", None), (9, "d", float("nan")), (10, "d", float("nan"))]


@pytest.mark.parametrize("merge", [False, True])
def test_unique(spark, merge):
    df = spark.createDataFrame(ROWS, "k int, v string, w double")
    with settings(spark, **(MERGE if merge else {})):
        assert got(df, {"type": "check_unique", "column": "v"}) == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True, 7: False, 8: False, 9: False, 10: False}
        # with a second column: a NULL in any part of the key fails, NaN equals NaN
        both = {"type": "check_unique", "column": "v", "columns": ["w"]}
        assert got(df, both) == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True, 7: False, 8: False, 9: False, 10: False}
        assert got(df, {"type": "check_unique", "column": "v", "digest": True, "salt_columns": ["k"]}) == got(df, {"type": "check_unique", "column": "v"})
    assert got(df.limit(0), both) == {}


def test_unique_judges_the_value_at_its_stage(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a ")], "k int, v string")
    p = Pipeline({"stages": [
        {"name": "a", "type": "dq", "rules": [{"id": "before", "type": "check_unique", "column": "v"}]},
        {"name": "b", "type": "cleanse", "rules": [{"type": "clean_trim", "column": "v"}, {"type": "clean_lowercase", "column": "v"}]},
        {"name": "c", "type": "dq", "rules": [{"id": "after", "type": "check_unique", "column": "v"}]}]})
    assert sorted(tuple(r) for r in p.compile(df).flat(["k"]).collect()) == [(1, "PASS", "FAIL"), (2, "PASS", "FAIL")]
    assert p.run(df).columns == ["k", "v", "_dq_results"]


@pytest.mark.parametrize("value", ["hot", None])
def test_a_hot_or_null_key_is_never_in_one_task(spark, value):
    """A key of two thirds of the rows, without any help of adaptive execution."""
    df = spark.range(0, 60000, 1, 8).select(F.col("id").alias("k"), F.when(F.col("id") % 3 < 2, F.lit(value)).otherwise(F.col("id").cast("string")).alias("v"))
    with settings(spark, **MERGE, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="64"):
        out = one({"type": "check_unique", "column": "v"}).compile(df).flat(["k", "v"])
        counts = {r["r"]: r["count"] for r in out.groupBy("r").count().collect()}
        assert counts == {"PASS": 20000, "FAIL": 40000}
        assert "SortMergeJoin" in plan(out)
        assert largest_partition(out) < 15000


def test_only_the_keys_are_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = one({"type": "check_unique", "column": "o_custkey"}).compile(df).flat(["o_orderkey"])
    with settings(spark, **{"spark.sql.maxMetadataStringLength": "2000"}):
        reads = {line.split("ReadSchema: ")[1] for line in plan(out).splitlines() if "ReadSchema: " in line}
    assert reads == {"struct<o_orderkey:bigint,o_custkey:bigint>", "struct<o_custkey:bigint>"}


def test_table_membership_reads_only_its_columns(spark):
    import __spark_entry__ as E

    with settings(spark, **MERGE, **{"spark.sql.maxMetadataStringLength": "2000"}):
        text = plan(E.lineitem_references(spark, "/root/testdata/sf0.001"))
    wide = [line for line in text.splitlines() if "ReadSchema: " in line and "l_orderkey" in line.split("ReadSchema: ")[1]]
    assert {line.split("ReadSchema: ")[1] for line in wide} == {"struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>"}


# -- intervals -----------------------------------------------------------------
def test_intervals_against_brute_force(spark):
    random.seed(3)
    f = lambda: random.choice([None, float("nan"), random.uniform(-30, 30), float(random.randrange(-30, 30))])
    table = [(random.choice("xyz") if random.random() < .9 else None, f(), f()) for _ in range(120)]
    rows = [(i, random.choice("xyzw") if random.random() < .9 else None, f()) for i in range(400)]
    t = spark.createDataFrame(table, "g string, lo double, hi double")
    df = spark.createDataFrame(rows, "k int, g string, v double")
    bad = lambda x: x is None or x != x
    for closed in ("both", "left"):
        for on in ([], ["g"], ["g=g"]):
            for width in (0.7, 5, 1000):
                for merge in ({}, MERGE) if width == 5 else ({},):
                    inside = lambda v, a, b: not bad(a) and not bad(b) and a <= v and (v < b if closed == "left" else v <= b)  # noqa: B023, E731
                    want = {k: not bad(v) and any((not on or (g is not None and g == h)) and inside(v, a, b) for h, a, b in table) for k, g, v in rows}
                    with settings(spark, **merge):
                        rule = {"type": "check_interval", "column": "v", "table": "t", "start": "lo", "end": "hi", "bin": width, "closed": closed, "on": on}
                        assert got(df, rule, tables={"t": t}) == want, (closed, on, width)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_intervals_of_time(spark, kind):
    day = lambda d: f"2024-03-{d:02d} 00:00:00"
    t = spark.createDataFrame([(day(1), day(3)), (day(2), day(5)), (day(9), day(9)), (day(8), day(7)), (None, day(20))], "a string, b string").selectExpr(f"cast(a as {kind}) a", f"cast(b as {kind}) b")
    df = spark.createDataFrame([(i, day(i)) for i in range(1, 12)] + [(99, None)], "k int, s string").selectExpr("k", f"cast(s as {kind}) v")
    rule = {"type": "check_interval", "column": "v", "table": "t", "start": "a", "end": "b", "bin": 86400 * 2}
    assert [k for k, ok in got(df, rule, tables={"t": t}).items() if ok] == [1, 2, 3, 4, 5, 9]
    assert got(df, rule, tables={"t": t.limit(0)}) == dict.fromkeys([*range(1, 12), 99], False)
    assert got(df.limit(0), rule, tables={"t": t}) == {}
    with pytest.raises(SpecError):
        one(rule).compile(df, tables={"t": spark.range(3).selectExpr("id a", "id b")})


def test_intervals_are_no_nested_loop_and_never_multiply_rows(spark):
    t = spark.range(3000).selectExpr("id % 50 AS lo", "id % 50 + 40 AS hi")  # thousands over one another
    df = spark.range(0, 30000, 1, 8).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS v")
    with settings(spark, **MERGE):
        out = one({"type": "check_interval", "column": "v", "table": "t", "start": "lo", "end": "hi", "bin": 10}).compile(df, tables={"t": t}).flat(["k", "v"])
        text = plan(out)
        assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text
        assert {r["r"]: r["count"] for r in out.groupBy("r").count().collect()} == {"PASS": 10000 + 30, "FAIL": 20000 - 30}  # 2, 5, ..., 89


# -- sequences -----------------------------------------------------------------
def brute_sequence(rows, lo=None, hi=None, first=None, repeats=False):
    """rows: (k, by, order, value)."""
    if lo is None and hi is None:
        lo = hi = 1
    places = defaultdict(lambda: defaultdict(list))
    for _, by, at, v in rows:
        if by is not None and at is not None and v is not None:
            places[by][at].append(v)
    ok = {}
    for by, mine in places.items():
        prev = None
        for at in sorted(mine):
            vs = mine[at]
            good = repeats or len(vs) == 1
            if prev is None:
                good &= first is None or min(vs) == first
            else:
                step = min(vs) - prev
                good &= (lo is None or step >= lo) and (hi is None or step <= hi)
            prev = max(vs)
            ok[by, at] = good
    return {k: v is not None and ok.get((by, at), False) for k, by, at, v in rows}


def sequence_rows():
    random.seed(11)
    out = [(i, random.choice(["a", "b", None]), random.choice([None, *range(60)]), random.choice([None, *range(70)])) for i in range(250)]
    out += [(1000 + i, "long", i, i) for i in range(300) if i not in (17, 100, 101)] + [(2000 + i, "long", 50, 50) for i in range(40)]
    return out + [(3000, "one", 5, 5), (3001, "zero", 0, 0)]


@pytest.mark.parametrize("params", [{}, {"lo": 0}, {"hi": 3}, {"lo": -2, "hi": 9, "repeats": True}, {"first": 0}])
def test_sequences_against_brute_force(spark, params):
    rows = sequence_rows()
    df = spark.createDataFrame(rows, "k int, by string, at int, v int")
    names = {"lo": "min_step", "hi": "max_step"}
    rule = {"type": "check_sequence", "column": "v", "by": ["by"], "order": "at", **{names.get(k, k): v for k, v in params.items()}}
    want = brute_sequence(rows, **params)
    for span in ({}, {"span": 1}, {"span": 7.5}, {"span": 1000}):
        assert got(df, rule | span) == want, span
    own = [(k, by, v, v) for k, by, _, v in rows]
    del rule["order"]
    with settings(spark, **MERGE):
        assert got(df, rule | {"span": 20}) == brute_sequence(own, **params)
    assert got(df.limit(0), rule) == {}


def test_sequence_of_times(spark):
    t = datetime.datetime(2024, 3, 30, 22)
    rows = [(i, "u", t + datetime.timedelta(hours=i * i)) for i in range(7)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(k, u, str(x)) for k, u, x in rows], "k int, u string, s string").selectExpr("k", "u", f"cast(s as {kind}) v")
        rule = {"type": "check_sequence", "column": "v", "by": ["u"], "max_step": 5 * 3600, "span": 7200}
        assert got(df, rule) == {0: True, 1: True, 2: True, 3: True, 4: False, 5: False, 6: False}
    with pytest.raises(SpecError):
        one(rule | {"column": "u"}).compile(df)


def test_one_key_of_any_length_is_checked_in_parallel(spark):
    """All rows are one key: each stretch is a group of its own, and repeats of one place are one row."""
    n = 40000
    df = spark.range(0, n, 1, 8).selectExpr("id AS k", "1 AS by", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS v")
    with settings(spark, **MERGE, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32"):
        run = one({"type": "check_sequence", "column": "v", "by": ["by"], "min_step": 1, "max_step": 2, "span": 500}).compile(df)
        # the places, dealt as the operator deals them
        places = df.groupBy("by", "v").agg(F.count(F.lit(1)).alias("n")).repartition(32, F.col("by"), F.floor(F.col("v") / 500.0))
        assert largest_partition(places) < n / 8
        counts = Counter(r["r"] for r in run.flat(["k"]).collect())
    # place 5 holds a third of the rows and its own: all of them repeat
    assert counts["FAIL"] == sum(1 for i in range(n) if i % 3 == 0 or i == 5) and sum(counts.values()) == n


@pytest.mark.parametrize("rule", [
    {"type": "check_interval", "column": "v", "table": "t", "start": "a", "end": "b", "bin": 0},
    {"type": "check_interval", "column": "v", "table": "t", "start": "a", "end": "b", "bin": 1, "closed": "right"},
    {"type": "check_sequence", "column": "v", "by": []},
    {"type": "check_sequence", "column": "v", "by": ["k"], "min_step": 3, "max_step": 2},
    {"type": "check_sequence", "column": "v", "by": ["k"], "span": -1},
])
def test_parameters_are_validated(rule):
    with pytest.raises(SpecError):
        one(rule)


def test_missing_columns_are_reported(spark):
    df = spark.range(3).selectExpr("id AS k", "id AS v")
    for rule in ({"type": "check_unique", "column": "v", "columns": ["nope"]}, {"type": "check_sequence", "column": "v", "by": ["nope"]}):
        with pytest.raises(SpecError, match="nope"):
            one(rule).compile(df)
