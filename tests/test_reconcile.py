"""Two versions of a table, and reports by level."""

import contextlib
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowlint import Pipeline, SpecError, reconcile, reconcile_summary

SCHEMA = "k int, a string, b double"


def brute(old, new):
    out = {}
    for k in {r[0] for r in old} | {r[0] for r in new}:
        o, n = Counter(r[1:] for r in old if r[0] == k), Counter(r[1:] for r in new if r[0] == k)
        no, nn = sum(o.values()), sum(n.values())
        cols = []
        if not no or not nn:
            change = "removed" if no else "added"
        elif o == n:
            continue
        elif len(set(o) | set(n)) == 1:
            change = "repeated"
        else:
            change = "changed"
            for i, c in enumerate("ab"):
                part = lambda s: Counter(v[i] for v, m in s.items() for _ in range(m))  # noqa: B023, E731
                if no != nn or part(o) != part(n):
                    cols.append(c)
        out[k] = (change, cols, no, nn)
    return out


def run(spark, old, new, **kw):
    rows = reconcile(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"], **kw).collect()
    assert len({r["k"] for r in rows}) == len(rows)
    return {r["k"]: (r["change"], r["changed_columns"], r["n_old"], r["n_new"]) for r in rows}


def test_against_brute_force(spark):
    random.seed(1)
    pick = lambda: (random.choice([None, *range(60)]), random.choice([None, "x", "y", ""]), random.choice([None, 1.0, -2.5]))
    for n in (0, 3, 90, 250):
        old = [pick() for _ in range(n)]
        new = [r for r in old if random.random() < .8] + [pick() for _ in range(n // 5)]
        assert run(spark, old, new) == brute(old, new)
    assert run(spark, [], new) == brute([], new) and run(spark, new, []) == brute(new, [])


def test_kinds(spark):
    old = [(1, "a", 1.0), (2, "a", 1.0), (3, "a", 1.0), (4, "a", 1.0), (5, "a", 1.0), (5, "b", 2.0), (6, None, 1.0), (None, "n", 0.0)]
    new = [(1, "a", 1.0), (2, "z", 1.0), (4, "a", 1.0), (4, "a", 1.0), (5, "a", 2.0), (5, "b", 1.0), (6, "", 1.0), (7, "new", 0.0), (None, "n", 9.0)]
    assert run(spark, old, new) == {2: ("changed", ["a"], 1, 1), 3: ("removed", [], 1, 0), 4: ("repeated", [], 1, 2), 5: ("changed", [], 2, 2),
                                    6: ("changed", ["a"], 1, 1), 7: ("added", [], 0, 1), None: ("changed", ["b"], 1, 1)}
    same = run(spark, old, new, keep_same=True)
    assert same[1] == ("same", [], 1, 1)
    changes = reconcile(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"])
    assert {(r["change"], r["column"]): r["n_keys"] for r in reconcile_summary(changes).collect()} == {
        ("changed", None): 4, ("changed", "a"): 2, ("changed", "b"): 1, ("removed", None): 1, ("added", None): 1, ("repeated", None): 1}
    assert 2 not in run(spark, old, new, columns=["b"])


def test_hot_key_costs_one_row_per_task(spark):
    old = spark.range(0, 60000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS k", "id % 5 AS a", "1.5 AS b")
    changes = reconcile(old, old.withColumn("a", F.when(F.col("k") == 4, 99).otherwise(F.col("a"))), ["k"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        changes.explain()
    text = buf.getvalue()
    assert [tuple(r) for r in changes.collect()] == [(4, "changed", ["a"], 1, 1)]
    assert text.count("Exchange hashpartitioning") == 1 and "partial_bit_xor" in text and "Join" not in text


def test_schemas(spark):
    a = spark.createDataFrame([(1, 5)], "k int, v int")
    b = spark.createDataFrame([(1, 5)], "v long, k long").selectExpr("v AS k", "k AS v")
    assert reconcile(a, b, ["k"]).collect() == []  # widened as in a union, by name
    with pytest.raises(ValueError, match="one side"):
        reconcile(a, b.withColumn("w", F.lit(1)), ["k"])
    assert reconcile(a, b.withColumn("w", F.lit(1)), ["k"], columns=["v"]).collect() == []
    with pytest.raises(ValueError, match="maps"):
        reconcile(a.withColumn("m", F.create_map(F.lit(1), F.lit(2))), a.withColumn("m", F.create_map(F.lit(1), F.lit(2))), ["k"])
    with pytest.raises(ValueError):
        reconcile(a, b, [])
    with pytest.raises(ValueError):
        reconcile(a.withColumnRenamed("k", "change"), b.withColumnRenamed("k", "change"), ["change"])


RULES = Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [
    {"id": "pos", "type": "check_min", "column": "v", "value": 0}, {"id": "nn", "type": "check_not_null", "column": "v"}]}]})


def test_rollup_levels(spark):
    rows = [("a", "x", 1), ("a", "x", -1), ("a", None, None), (None, "x", 2), ("b", "y", -5)]
    run = RULES.compile(spark.createDataFrame(rows, "g string, h string, v int"))
    got = {(r["g"], r["h"], r["level"], r["rule_id"]): (r["n_pass"], r["n_fail"], r["n_rows"]) for r in run.rollup(["g", "h"]).collect()}
    assert got[None, None, 3, "pos"] == (2, 3, 5) and got[None, None, 3, "nn"] == (4, 1, 5)
    assert got["a", None, 1, "pos"] == (1, 2, 3) and got["a", None, 0, "pos"] == (0, 1, 1)  # a total beside a NULL of the data
    assert got[None, None, 1, "pos"] == (1, 0, 1) and got[None, "x", 0, "nn"] == (1, 0, 1)
    assert len(got) == 2 * (1 + 3 + 4)
    only = run.rollup(["g", "h"], sets=[["h"], []]).collect()
    assert {(r["h"], r["level"], r["n_rows"]) for r in only} == {("x", 2, 3), (None, 2, 1), ("y", 2, 1), (None, 3, 5)}
    assert RULES.compile(spark.createDataFrame([], "g string, h string, v int")).rollup(["g"]).collect() == []
    clash = RULES.compile(spark.createDataFrame([("a", 1, "x")], "n string, v int, p0 string"))
    assert clash.rollup(["n", "p0"]).count() == 6
    with pytest.raises(SpecError):
        run.rollup([])
    with pytest.raises(SpecError):
        run.rollup(["g"], sets=[["h"]])


def test_rollup_expands_partial_counts_only(spark):
    run = RULES.compile(spark.range(0, 60000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE id % 7 END AS g", "id % 2 AS h", "id AS v"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        run.rollup(["g", "h"]).explain()
    text = buf.getvalue()
    assert text.count("Expand") == 1 and text.count("Range (") == 1
    lines = text.splitlines()
    at = {w: next(i for i, x in enumerate(lines) if w in x) for w in ("Expand", "Range (")}
    exchanges = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert any(at["Expand"] < i < at["Range ("] for i in exchanges)  # counted and exchanged before it is expanded


def test_worst_rows(spark):
    rows = [(i, (i * 7) % 100 - 50) for i in range(100)] + [(200, None), (201, None)]
    run = RULES.compile(spark.createDataFrame(rows, "k int, v int").repartition(4))
    got = [tuple(r) for r in run.worst(3, ["k", "v"], by=["v"]).orderBy("rule_id", "rank").collect()]
    low = sorted((v, k) for k, v in rows if v is not None and v < 0)
    assert got == [("nn", 1, 200, None), ("nn", 2, 201, None), ("pos", 1, 200, None), ("pos", 2, 201, None), ("pos", 3, low[0][1], low[0][0])]
    down = [tuple(r) for r in run.worst(2, ["k"], by=[F.desc_nulls_last("v")]).where("rule_id = 'pos'").orderBy("rank").collect()]
    assert down == [("pos", 1, low[-1][1]), ("pos", 2, low[-2][1])]
    assert run.worst(0, ["k"]).collect() == [] and Pipeline({"stages": []}).compile(spark.range(3)).worst(2, ["id"]).collect() == []
    assert RULES.compile(spark.createDataFrame([], "k int, v int")).worst(2, ["k"]).collect() == []


def test_worst_rows_limits_before_the_exchange(spark):
    run = RULES.compile(spark.range(0, 60000, 1, 8).selectExpr("id AS k", "-id AS v"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        run.worst(5, ["k"], by=["v"]).explain()
    lines = buf.getvalue().splitlines()
    limits = [i for i, x in enumerate(lines) if "WindowGroupLimit" in x]
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]
