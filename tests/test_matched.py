"""Events judged by other events: batch against brute force, stream against batch."""

import datetime
import random
import uuid

import pytest
from pyspark.sql import functions as F

from rowlint import matched_within, unique_within
from rowlint.streaming.matched import interval_micros

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "id int, u string, t timestamp_ntz, kind string, status2 string"


def rows(n=400, seed=1):
    random.seed(seed)
    out = []
    for i in range(n):
        u = random.choice(["a", "b", "hot", "hot", "hot", None if random.random() < .2 else "c"])
        t = T0 + datetime.timedelta(minutes=random.randrange(0, 60 * 48, 5)) if random.random() > .03 else None
        out.append((i, u, t, random.choice(["ask", "reply", "other", None]), "x"))
    return out + [(1000, "d", T0, "ask", "x"), (1001, "d", T0 + datetime.timedelta(hours=2), "reply", "x"), (1002, "e", T0, "ask", "x"),
                  (1003, "e", T0 + datetime.timedelta(hours=2, microseconds=1), "reply", "x"), (1004, "f", T0, "ask", "x"), (1005, "f", T0, "reply", "x"),
                  (1006, "g", T0, "ask", "x"), (1006, "g", T0, "ask", "x"), (1007, "g", T0 + datetime.timedelta(hours=1), "reply", "x")]


def brute_matched(data, hours=2):
    span = datetime.timedelta(hours=hours)
    ok = lambda r: any(s[3] == "reply" and s[1] == r[1] and s[2] is not None and r[2] < s[2] <= r[2] + span for s in data)
    return sorted((r[0], "PASS" if r[1] is not None and r[2] is not None and ok(r) else "FAIL") for r in data if r[3] == "ask")


def brute_unique(data, hours=2):
    span = datetime.timedelta(hours=hours)
    out = []
    for r in data:
        good = r[1] is not None and r[2] is not None and not any(
            s[1] == r[1] and s[2] is not None and (s[2], s[0]) < (r[2], r[0]) and r[2] - s[2] <= span for s in data)
        out.append((r[0], "PASS" if good else "FAIL"))
    return sorted(out)


def asked(df, **kw):
    return matched_within(df, ["u"], "t", F.col("kind") == "ask", F.col("kind") == "reply", "2 hours", **kw)


def pairs(df):
    return sorted((r["id"], r["status"]) for r in df.select("id", "status").collect())


def test_matched_against_brute_force(spark):
    for seed in (1, 2):
        data = rows(seed=seed)
        df = spark.createDataFrame(data, SCHEMA)
        out = asked(df)
        assert pairs(out) == brute_matched(data) and out.columns == [*df.columns, "status"]
    assert asked(df.limit(0)).collect() == []
    # a row that both asks and answers never answers itself
    own = matched_within(df, ["u"], "t", F.lit(True), F.lit(True), "2 hours").where("id in (1002, 1003)")
    assert pairs(own) == [(1002, "FAIL"), (1003, "FAIL")]


def test_repeats_against_brute_force(spark):
    data = [r for r in rows() if r[0] != 1006]
    df = spark.createDataFrame(data, SCHEMA)
    out = unique_within(df, ["u"], "t", "2 hours", order=["id"])
    assert pairs(out) == brute_unique(data) and out.columns == [*df.columns, "status"]
    assert unique_within(df.limit(0), ["u"], "t", "2 hours").collect() == []


def test_a_hot_key_is_cut_by_time(spark):
    df = spark.range(0, 50000, 1, 8).select(F.col("id").alias("id"), F.lit("hot").alias("u"),
                                            F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id)").alias("t"),
                                            F.when(F.col("id") % 2 == 0, "ask").otherwise("reply").alias("kind"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for out in (matched_within(df, ["u"], "t", F.col("kind") == "ask", F.col("kind") == "reply", "20 minutes"), unique_within(df, ["u"], "t", "20 minutes", order=["id"])):
            sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            assert max(sizes) < sum(sizes) / 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_of(spark, tmp_path, parts):
    top = str(tmp_path / uuid.uuid4().hex)
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{top}/in")
    return top, lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{top}/in")


def run(df, top):
    df.writeStream.format("parquet").option("path", f"{top}/out").option("checkpointLocation", f"{top}/state").trigger(availableNow=True).start().awaitTermination(180)


def test_matched_stream_equals_batch(spark, tmp_path):
    data = [r for r in rows(150) if r[1] is not None and r[2] is not None and r[0] != 1006]
    data.sort(key=lambda r: r[2])
    end = [(5000, "zz", T0 + datetime.timedelta(days=300), "reply", "x"), (5001, "zz", T0 + datetime.timedelta(days=300), "ask", "x")]
    half = len(data) // 2
    top, source = stream_of(spark, tmp_path, [data[:half], data[half:], end])
    run(asked(source(), watermark="10 minutes"), top)
    assert pairs(spark.read.parquet(f"{top}/out").where("u <> 'zz'")) == brute_matched(data)
    with pytest.raises(ValueError):
        asked(source())


def test_a_restarted_stream_marks_no_event_twice(spark, tmp_path):
    data = [r for r in rows(150) if r[1] is not None and r[2] is not None and r[0] != 1006]
    data.sort(key=lambda r: (r[2], r[0]))
    half = len(data) // 2
    top, source = stream_of(spark, tmp_path, [data[:half]])
    judge = lambda: unique_within(source(), ["u"], "t", "2 hours", order=["id"], watermark="10 minutes")
    run(judge(), top)
    spark.createDataFrame(data[half:], SCHEMA).coalesce(1).write.mode("append").parquet(f"{top}/in")
    run(judge(), top)  # goes on from the checkpoint: the first half is known and not read again
    run(judge(), top)
    back = spark.read.parquet(f"{top}/out")
    assert pairs(back) == brute_unique(data)
    assert sorted(map(tuple, back.select("id", "u", "t", "kind", "status2").collect())) == sorted(data)
    with pytest.raises(ValueError):
        unique_within(source(), ["u"], "t", "2 hours")


def test_intervals_are_read_and_refused(spark):
    assert interval_micros("1 day 6 hours") == 30 * 3600 * 10**6 and interval_micros("90 Minutes") == 5400 * 10**6
    for text in ("", "2", "1 month", "0 hours", "x hours"):
        with pytest.raises(ValueError):
            interval_micros(text)
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        asked(df, status="kind")
