from oracle import duck
from pyspark.sql import functions as F

import corpus_pipeline as P
from rowlint.llm import decontam, line_dedup, mixing, near_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    steps = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    kept = steps["toxicity"](spark, docs, SF)
    scores = toxicity.with_scores(docs, toxicity.train(docs, labels))
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in scores.where("score < 0.7").select("doc_id").collect())
    cut = steps["line_dedup"](spark, docs, SF)
    report = {r["doc_id"]: r["kept_text"] for r in line_dedup.line_report(docs).collect()}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == report
    ones = steps["near_dedup"](spark, docs, SF)
    classes = near_dedup.near_duplicates(docs).collect()
    assert sorted(r["doc_id"] for r in ones.collect()) == sorted({r["class_id"] for r in classes})
    clean = steps["decontamination"](spark, docs, SF)
    m = decontam.Matcher([(r["item_id"], r["text"]) for r in items.collect()], decontam.RATE)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r["doc_id"] for r in docs.collect() if not m.find(r["text"]))
    for df in (kept, cut, ones, clean):
        assert df.columns == docs.columns
    mixed = steps["mixing"](spark, docs, SF)
    assert mixed.columns == [*docs.columns, "copies", "domain", "tokens"] and mixed.where("copies < 1").count() == 0


def test_run(spark):
    out = P.run(spark, SF)
    assert out.count() > 0
    ids = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in out.collect()} <= ids


def test_mixing_keeps_its_result_on_a_name_clash(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = dict(P.STAGES)["mixing"](spark, docs, SF)
    odd = docs.withColumns({"copies": F.lit(-7), "tokens": F.lit("mine"), "input_tokens": F.lit("first")})
    got = dict(P.STAGES)["mixing"](spark, odd, SF)
    assert got.columns == [*docs.columns, "input_copies", "input_input_tokens", "input_tokens", "copies", "domain", "tokens"]
    same = ["doc_id", "copies", "domain", "tokens"]
    assert sorted(got.select(*same).collect()) == sorted(plain.select(*same).collect())
    assert {(r[0], r[1], r[2]) for r in got.select("input_copies", "input_input_tokens", "input_tokens").collect()} == {(-7, "mine", "first")}


def test_mixing_against_plain_counts(spark):
    """Every chosen document as often as its leaf's budget says: whole epochs, and a prefix that ends with the first document past the rest."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = dict(P.STAGES)["mixing"](spark, docs, SF).collect()
    con = duck(SF)
    want = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, copies FROM ({mixing.OP10_SQL})").fetchall()}
    assert {r["doc_id"]: r["copies"] for r in mixed} == want


def write(spark, folder, docs):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, copies int").write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")


def test_run_over_nulls_repeats_and_extra_columns(spark, tmp_path):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first()["text"]
    words = " ".join(f"word{i} stands here and there" for i in range(30))
    docs = [(1, words, "en", "s1", 1, 5), (2, words, "en", "s1", 1, 5), (2, words, None, None, None, None), (3, None, None, "s2", None, 1), (4, "", "en", "s2", 0, 1),
            (None, words + " but not quite the same in the end", "de", "s1", 3, 2), (5, "x " + item + " y", "en", "s2", 9, 9), (6, "alone and short", "en", "s3", 2, 2)]
    write(spark, str(tmp_path / "a"), docs)
    out = P.run(spark, str(tmp_path / "a"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "input_copies", "copies", "domain", "tokens"]
    rows = out.collect()
    ids = [r["doc_id"] for r in rows]
    assert 5 not in ids and {1, 6} <= set(ids) and all(r["copies"] >= 1 for r in rows)
    # line dedup empties the repeats of document 1; empty texts are one class, whose smallest id is 2
    assert {r["doc_id"] for r in rows if not r["text"]} <= {2} and [r["text"] for r in rows if r["doc_id"] == 1] == [words]
    write(spark, str(tmp_path / "b"), [])
    assert P.run(spark, str(tmp_path / "b")).collect() == []
