import random
import zlib

import numpy as np
import pytest

from rowlint.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def test_words_and_borders():
    def words(text):
        c, starts, doc = T.word_stream([text])
        return [c[a + 1:b - 1].tolist() for a, b in zip(starts, starts[1:], strict=False)]

    assert words("i.d.i.o.t") == words("idiot") == words("i d i o t") == words("IDIOT!")
    assert len(words("a cat sat")) == 3
    assert words("") == [] and words("... !!") == []
    c, starts, doc = T.word_stream(["", "one two", "", "three"])
    assert doc.tolist() == [1, 1, 3]


def test_kernel_tolerates_gaps():
    def phi(word):
        c, starts, _ = T.word_stream([word])
        v = np.zeros(T.SIZE ** 3)
        for _, code, w in T.subsequences(c, starts):
            np.add.at(v, code, w)
        return v / np.linalg.norm(v)

    assert phi("idiot") @ phi("idiiot") > phi("idiot") @ phi("island")
    assert phi("idiot") @ phi("idxiot") > 0.3


def test_subsequences_against_brute_force():
    c, starts, _ = T.word_stream(["abcab", "xy"])
    got = sorted((int(code), w) for _, codes, w in T.subsequences(c, starts) for code in codes)
    want = []
    for a, b in zip(starts, starts[1:], strict=False):
        w = c[a:b].astype(int)
        for i in range(len(w)):
            for g, h in T.GAPS:
                if i + 2 + g + h < len(w):
                    want.append((w[i] << 12 | w[i + 1 + g] << 6 | w[i + 2 + g + h], T.DECAY ** (g + h)))
    assert got == sorted(want)


@pytest.fixture(scope="module")
def scored(spark):
    from rowlint.llm.queries import QUERIES

    return QUERIES["op5_toxicity"](spark, SF).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = scored.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in held["doc_id"]]).all()
    assert ((held["predicted"] == held["toxic"]).mean()) >= 0.95
    clean = held[held["toxic"] == 0]
    assert (clean["predicted"] == 0).mean() >= 0.99
    assert scored["score"].between(0, 1).all() and len(scored) == 1000


def test_does_not_depend_on_row_order(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("text").repartition(5)
    model = T.train(docs, spark.read.parquet(f"{SF}/labels.parquet").orderBy("toxic").repartition(3))
    again = T.with_scores(docs, model).select("doc_id", "score").toPandas().sort_values("doc_id")
    assert np.allclose(again["score"], scored.sort_values("doc_id")["score"], atol=1e-6)


def test_edge_cases(spark):
    random.seed(0)
    docs = [(i, " ".join(random.choice(["good", "fine", "words", "here"]) for _ in range(30)) + (" you awfulword" * 3 if i % 2 else "")) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (3, 7)]
    df = spark.createDataFrame([(d, t, 0.5) for d, t in [*docs, (None, None), (61, ""), (62, "awful.word " + "x" * 300000), (2, docs[2][1])]], "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.train(df, lab)
    out = T.with_scores(df, model)
    assert out.columns == ["doc_id", "text", "score"] and out.count() == 64
    rows = {r["doc_id"]: r["score"] for r in out.collect()}
    assert all((rows[i] >= 0.5) == bool(i % 2) for i in range(60))
    kept = T.drop_toxic(df, lab)
    assert kept.columns == df.columns
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert T.drop_toxic(empty, spark.createDataFrame([], "doc_id long, toxic int")).collect() == []
    assert T.drop_toxic(df, spark.createDataFrame([], "doc_id long, toxic int")).count() == 64
