"""Streams equal batches; split, observe and report sinks keep every row."""

import shutil

from pyspark.sql import functions as F

from rowlint import Pipeline
from rowlint.sources import spread, write_reports, write_split
from rowlint.streaming import annotate_stream, quality_by_window

from conftest import SF001

EVENTS = {"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "big", "type": "check_min", "column": "value", "value": 100},
        {"id": "kind", "type": "check_in_set", "column": "event_type", "values": ["view", "click"]}]},
    {"name": "std", "type": "cleanse", "rules": [{"type": "clean_uppercase", "column": "event_type"}]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "kind_upper", "type": "check_in_set", "column": "event_type", "values": ["VIEW", "CLICK"]}]},
]}


def events_dir(tmp_path):
    d = tmp_path / "events"
    d.mkdir()
    shutil.copy(f"{SF001}/events.parquet", d / "part-0.parquet")
    return str(d)


def test_stream_equals_batch(spark, tmp_path):
    src = events_dir(tmp_path)
    batch_df = spark.read.parquet(src)
    p = Pipeline(EVENTS)
    stream = annotate_stream(p, spark.readStream.schema(batch_df.schema).parquet(src))
    q = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = p.run(batch_df)
    cols = ["event_id", "event_type", F.col("_dq_results")["big"], F.col("_dq_results")["kind_upper"]]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert got.count() == 1000


def test_windowed_quality_stream_equals_batch(spark, tmp_path):
    src = events_dir(tmp_path)
    batch_df = spark.read.parquet(src)
    p = Pipeline(EVENTS)
    want = quality_by_window(p.compile(batch_df), "ts", "1 day")
    run = p.compile(spark.readStream.schema(batch_df.schema).parquet(src))
    agg = quality_by_window(run, "ts", "1 day", watermark="1 hour")
    q = (agg.writeStream.outputMode("update").format("memory").queryName("dq_windows")
         .option("checkpointLocation", str(tmp_path / "ckpt2")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("dq_windows")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.groupBy().sum("n_rows").first()[0] == 3 * 1000


def test_split_keeps_every_row(spark, tmp_path):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    run = Pipeline(EVENTS).compile(df)
    clean, bad = run.split()
    assert clean.count() + bad.count() == df.count()
    assert clean.where("_dq_failed > 0").count() == 0
    write_split(run, str(tmp_path / "split"))
    back = spark.read.parquet(str(tmp_path / "split"))
    assert back.count() == df.count()
    assert back.where("_dq_passed = 'true'").count() == clean.count()  # partition values read back as text


def test_observed_counts_while_writing(spark, tmp_path):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    run = Pipeline(EVENTS).compile(df)
    out, obs = run.observed()
    out.write.format("noop").mode("overwrite").save()
    counts = obs.get
    want = {r.rule_id: r.n_pass for r in run.summary().collect()}
    assert counts["_rows"] == 1000
    assert {k: counts[k] for k in want} == want


def test_write_reports(spark, tmp_path):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    run = Pipeline(EVENTS).compile(df)
    write_reports(run, str(tmp_path / "rep"), ["event_id"])
    assert spark.read.parquet(str(tmp_path / "rep/annotated")).count() == 1000
    assert spark.read.parquet(str(tmp_path / "rep/flat")).columns == ["event_id", "big", "kind", "kind_upper"]
    assert spark.read.parquet(str(tmp_path / "rep/summary")).count() == 3


def test_spread_is_the_callers_choice(spark):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    assert spread(df, 5, ["event_id"]).rdd.getNumPartitions() == 5
    assert spread(df, 3).rdd.getNumPartitions() == 3


def test_reports_read_the_input_once(spark, tmp_path):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    run = Pipeline(EVENTS).compile(df.mapInArrow(seen, df.schema))
    write_reports(run, str(tmp_path / "rep"), ["event_id"])
    assert reads.value == 1000
    want = Pipeline(EVENTS).compile(df)
    for name, frame in (("annotated", want.annotated()), ("flat", want.flat(["event_id"])), ("summary", want.summary())):
        got = spark.read.parquet(str(tmp_path / "rep" / name))
        assert sorted(map(str, got.collect())) == sorted(map(str, frame.collect())), name


def test_restarted_stream_repeats_no_row(spark, tmp_path):
    import uuid

    import pytest

    from rowlint.streaming import stream_checkpoint, write_annotated_stream

    class Unset:  # a session without the setting
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        stream_checkpoint(Unset, "x")
    src = events_dir(tmp_path)
    schema = spark.read.parquet(src).schema
    name = f"restart_{uuid.uuid4().hex}"
    for _ in range(2):
        write_annotated_stream(Pipeline(EVENTS), spark.readStream.schema(schema).parquet(src), str(tmp_path / "out"), name,
                               available_now=True).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_untimed_rows_are_counted(spark):
    from rowlint.streaming import quality_by_window, rows_without_time

    df = spark.createDataFrame([(1, None), (2, "2024-01-01 10:00:00"), (None, None)], "v int, t string").selectExpr("v", "cast(t as timestamp) t")
    run = Pipeline({"stages": [{"name": "s", "type": "dq", "rules": [{"id": "r", "type": "check_not_null", "column": "v"}]}]}).compile(df)
    got = {(r.window_start is None, r.n_pass, r.n_fail, r.n_rows) for r in quality_by_window(run, "t", "1 day").collect()}
    assert got == {(True, 1, 1, 2), (False, 1, 0, 1)}
    assert rows_without_time(run, "t").count() == 2
    empty = Pipeline({"stages": []}).compile(df)
    assert quality_by_window(empty, "t", "1 day").collect() == []


def test_command_line_job(spark, tmp_path):
    from rowlint.__main__ import main
    from rowlint.specs import spec_path

    csv = tmp_path / "customers.csv"
    csv.write_text("id,name,email\n1,John Doe,John.Doe@Example.com\n3,Bob Jones,  Bob.Jones@Example.com \n5,Charlie Black,\n")
    out = tmp_path / "out"
    assert main(["--spec", spec_path("email_standardize"), "--input", str(csv), "--format", "csv",
                 "--output", str(out), "--keys", "id"], spark=spark) == 0
    flat = {r.id: (r.rule_1, r.rule_2, r.rule_3) for r in spark.read.parquet(str(out / "flat")).collect()}
    assert flat == {"1": ("PASS", "PASS", "PASS"), "3": ("PASS", "FAIL", "PASS"), "5": ("FAIL", "FAIL", "FAIL")}
    assert spark.read.parquet(str(out / "annotated")).count() == 3


def test_stream_writer_checkpoints_under_the_session_folder(spark, tmp_path):
    from rowlint.streaming import stream_checkpoint, write_annotated_stream

    import uuid

    src = events_dir(tmp_path)
    schema = spark.read.parquet(src).schema
    name = f"events_dq_{uuid.uuid4().hex}"  # the folder is shared and outlives this run
    ckpt = stream_checkpoint(spark, name)
    assert ckpt.endswith(f"/rowlint-streams/{name}")
    q = write_annotated_stream(Pipeline(EVENTS), spark.readStream.schema(schema).parquet(src),
                               str(tmp_path / "annotated"), name, available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "annotated")).count() == 1000


def test_write_annotated_partitioned_and_rule_ids(spark, tmp_path):
    from rowlint import report
    from rowlint.sources import write_annotated

    df = spark.read.parquet(f"{SF001}/events.parquet")
    run = Pipeline(EVENTS).compile(df)
    write_annotated(run, str(tmp_path / "ann"), partition_by=["event_type"])
    back = spark.read.parquet(str(tmp_path / "ann"))
    assert back.count() == 1000
    assert sorted(r.rule_id for r in report.rule_ids(back).collect()) == ["big", "kind", "kind_upper"]
    assert {r.event_type for r in back.select("event_type").distinct().collect()} == {
        "VIEW", "CLICK", "PURCHASE", "SIGNUP", "ERROR"}


def test_spread_round_robin_keeps_every_row(spark):
    df = spark.read.parquet(f"{SF001}/events.parquet")
    s = spread(df, df.rdd.getNumPartitions() + 4)
    assert s.rdd.getNumPartitions() == df.rdd.getNumPartitions() + 4
    assert sorted(r.event_id for r in s.select("event_id").collect()) == sorted(r.event_id for r in df.select("event_id").collect())
