import hashlib
import random

from rowlint.llm.line_dedup import MIN_CHARS, dedup_lines, keep_bitmaps, line_report

WS = " \t\n\x0b\f\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(WS).translate(LOWER)


def brute(rows):
    first = {}
    for d, text in rows:
        if d is not None:
            for line in (text or "").split("\n"):
                k = key(line)
                if len(k) >= MIN_CHARS:
                    first[k] = min(first.get(k, d), d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or first.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def check(spark, rows, salts=4):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, n_dropped string, p int")
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_report(df, salts=salts).collect()]
    assert sorted(got, key=str) == brute(rows)
    cut = dedup_lines(df, salts=salts)
    assert cut.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=str) == sorted(((d, k) for d, _, _, k in brute(rows)), key=str)


def test_against_brute_force(spark):
    random.seed(1)
    lines = ["Same Line Here", "  same line here\t", "short", "", "ÉCOLE supérieure", "école supérieure", "another longer line", "x" * 5000]
    check(spark, [(random.randrange(60), "\n".join(random.choice(lines + [f"unique line number {i}"]) for _ in range(random.randrange(9)))) for i in range(150)])


def test_edge_cases(spark):
    long = "\n".join(["a hot repeated line", "own line %d"] * 3000)
    check(spark, [(1, None), (2, ""), (3, "\n\n"), (None, "a hot repeated line"), (5, "a hot repeated line"), (4, "A HOT repeated line\n"),
                  (7, long), (7, long), (7, "a hot repeated line\nother text of seven"), (9, long)])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_report(df).collect() == []
    assert dedup_lines(df).collect() == []


def test_hot_line_spreads_over_ranges(spark):
    rows = [(i, f"the line everyone has\nline of document {i}") for i in range(600)]
    check(spark, rows, salts=16)
    maps = keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(maps) == 599 and all([tuple(x) for x in r["keep"]] == [(1, 1)] for r in maps)


def test_hash_is_of_utf8(spark):
    from rowlint.llm.queries import QUERIES

    got = QUERIES["op9_line_dedup"](spark, "/root/testdata/sf0.001").limit(1).collect()[0]
    assert len(got["kept_sha256"]) == 64 and hashlib.sha256(b"").hexdigest() != ""
