"""Line dedup: repeated lines stay only in the first document that holds them.

Method.  Every line's key (the line without ASCII white space at both ends,
A-Z lower-cased) is hashed; the slim rows (hash, document, position)
are range-partitioned by hash and sorted by document and position inside each
partition, and one streaming pass marks first occurrences.  The result is a
compressed keep bitmap per document (run lengths), never text; texts are cut
by the bitmaps at the end.

A hot line may sit in a third of all documents.  The range key is therefore
(hash, salt of the document): a hot hash spreads over ``salts`` ranges, each
marks its own first occurrence, and only those (at most ``salts`` per hash)
meet once more to find the first of all.

JVM expressions only; no Python runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import SPACE, col, lower_ascii, written

MIN_CHARS = 10
SALTS = 256


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    # t tells rows apart that repeat a doc_id with another text
    text = F.coalesce(col(text_col), F.lit(""))
    return docs.select(*more, col(id_col).alias("__d"), text.alias("__x"), F.xxhash64(text).alias("__t"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, salts: int = SALTS) -> DataFrame:
    """``d, t, keep`` for every document that loses a line.

    ``d`` is the id, ``t`` the xxhash64 of the text, ``keep`` the compressed
    bitmap: the kept lines as runs ``(start, length)`` in order.  Documents
    without an entry keep every line.  Rows with a null id take no part.
    """
    rows = _rows(docs, id_col, text_col).where(F.col("__d").isNotNull())
    # the trimmed line is as long as its key: short lines go before any case mapping
    lines = (
        rows.select(F.col("__d").alias("d"), F.col("__t").alias("t"), F.split("__x", "\n").alias("a"))
        .select("d", "t", F.size("a").alias("n"), F.posexplode("a").alias("p", "line"))
        .select("d", "t", "n", "p", F.btrim("line", F.lit(SPACE)).alias("k"))
        .where(F.char_length("k") >= min_chars)
        .select(F.unhex(F.md5(lower_ascii(F.col("k")))).alias("h"), F.pmod(F.xxhash64("d"), F.lit(salts)).cast("int").alias("s"), "d", "t", "n", "p")
    )
    lines = written(lines, "lines")
    # RangePartitioning(h, s) already clusters (h, s): the window adds no exchange
    by = Window.partitionBy("h", "s").orderBy("d", "p", "t")
    marked = written(
        lines.repartitionByRange("h", "s").sortWithinPartitions("h", "s", "d", "p", "t")
        .withColumns({"lo": F.first("d").over(by), "rn": F.row_number().over(by)}), "marked")
    firsts = marked.where("rn = 1").select("h", "s", "lo")
    losers = (firsts.withColumn("all", F.min("lo").over(Window.partitionBy("h")))
              .where(F.col("lo") > F.col("all")).select("h", "s"))
    later = marked.where(F.col("d") > F.col("lo")).select("d", "t", "n", "p")
    first = marked.where(F.col("d") == F.col("lo")).join(losers, ["h", "s"]).select("d", "t", "n", "p")
    # islands of consecutive dropped positions, then their complement
    doc = Window.partitionBy("d", "t").orderBy("p")
    runs = (
        later.unionByName(first).distinct()
        .withColumn("island", F.col("p") - F.row_number().over(doc))
        .groupBy("d", "t", "n", "island").agg(F.min("p").alias("start"), F.count(F.lit(1)).cast("int").alias("len"))
        .groupBy("d", "t", "n").agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("drop"))
    )
    keep = F.expr("""filter(transform(sequence(0, size(drop)),
        i -> named_struct('start', if(i = 0, 0, drop[i - 1].start + drop[i - 1].len),
                          'length', if(i = size(drop), n, drop[i].start) - if(i = 0, 0, drop[i - 1].start + drop[i - 1].len))),
        r -> r.length > 0)""")
    return runs.select("d", "t", keep.alias("keep"))


def _cut(docs, id_col, text_col, min_chars, salts, *more):
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, salts)
    rows = _rows(docs, id_col, text_col, *more)
    joined = rows.join(maps.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.col("keep").alias("__keep")),
                       ["__d", "__t"], "left")
    lines = F.split("__x", "\n")
    kept = F.flatten(F.transform("__keep", lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    n_kept = F.aggregate("__keep", F.lit(0), lambda a, r: a + r["length"])
    text = F.when(F.col("__keep").isNull(), F.col("__x")).otherwise(F.array_join(kept, "\n"))
    dropped = F.when(F.col("__keep").isNull(), F.lit(0)).otherwise(F.size(lines) - n_kept)
    return joined, text, F.size(lines), dropped


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, salts: int = SALTS) -> DataFrame:
    """``docs`` with repeated lines cut from the text; every row and column stays.

    A line loses all its places except those in the smallest ``id_col`` that
    holds its key, if the key has at least ``min_chars`` code points.

    Null text counts as empty (one empty line) and comes back empty.  Rows with
    a null id keep their lines and do not count as holders.  Rows that repeat
    an id are one holder, each cut by its own text.  Empty input gives empty
    output.  Other columns pass through whatever their names.
    """
    whole = F.struct(*[col(c) for c in docs.columns]).alias("__row")
    joined, text, _, _ = _cut(docs, id_col, text_col, min_chars, salts, whole)
    return joined.select(*[text.alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, salts: int = SALTS) -> DataFrame:
    """One row per document: the id, ``n_lines``, ``n_dropped`` and ``kept_text``.

    Same rules and edge cases as :func:`dedup_lines`.
    """
    joined, text, n, dropped = _cut(docs, id_col, text_col, min_chars, salts)
    return joined.select(F.col("__d").alias(id_col), n.cast("long").alias("n_lines"),
                         dropped.cast("long").alias("n_dropped"), text.alias("kept_text"))


def op9_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_report(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def lines_sql(docs: str) -> str:
    """DuckDB CTEs over table ``docs``; ``ld`` has every line with its fate."""
    return f"""ld0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM {docs}),
ld1 AS (SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS p FROM ld0),
ld2 AS (SELECT doc_id, p, line, {_KEY} AS k FROM ld1),
ld3 AS (SELECT k, min(doc_id) AS lo FROM ld2 WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING min(doc_id) < max(doc_id)),
ld AS (SELECT ld2.doc_id, p, line, coalesce(ld2.doc_id > lo, false) AS gone FROM ld2 LEFT JOIN ld3 ON ld2.k = ld3.k),
ld_docs AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '') AS kept FROM ld GROUP BY doc_id)"""


OP9_SQL = f"WITH {lines_sql('documents')} SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ld_docs"
