"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domain, then language, then source.  A token budget is
pushed from the root to the leaves in proportion to the weights.  A child
that cannot use its share (all its documents, ``max_epochs`` times) is given
what it has, and the rest goes to its siblings in proportion to their weights;
only what a whole subtree cannot use goes back to the ancestor's other
children.  All of it is integer arithmetic on one row per node.

A leaf that is owed ``q`` whole epochs and a rest gives every document ``q``
times, and the documents of a token prefix of one more epoch once more.  The
order of an epoch is a hash ring: documents lie on it by the MD5 of seed and
id, cut into 4,096 arcs, and each epoch starts at its own seeded arc.  Prefix
sums run over the arcs of a leaf (4,096 rows at most) and inside single arcs,
so no task ever sorts a whole leaf, however large the leaf is.

JVM expressions only; no Python runs on executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import col, words

LEVELS = ("domain", "lang", "source")
ARCS = 4096
SEED = 17
MAX_EPOCHS = 2
SHARE = (3, 4)  # budget: this share of all tokens
# weights by level and name; every other name at that level weighs DEFAULT_WEIGHT
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 6, "de": 3, "fr": 3, "es": 2},
    "source": {"src0": 3},
}
DEFAULT_WEIGHT = 1
DOMAINS = 4


def domain_of(source: Column) -> Column:
    """The domain of a source: by the number at the end of its name, modulo 4."""
    n = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(n == "", F.lit("other")).otherwise(F.concat(F.lit("domain"), (n.cast("int") % DOMAINS).cast("string")))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    c = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.get(level, {}).items():
        if w < 0 or w != int(w):
            raise ValueError("weights are whole numbers from 0")
        c = F.when(F.col(level) == name, F.lit(int(w))).otherwise(c)
    return c.cast("decimal(38,0)")


def _offset(seed: int, epochs: int) -> list[int]:
    return [int(hashlib.md5(f"{seed}/{e}".encode()).hexdigest()[:3], 16) for e in range(epochs + 1)]


def allocate(leaves: DataFrame, levels: tuple[str, ...], weights: Mapping[str, Mapping[str, int]],
             share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (level columns, ``tokens``) with ``given``: the leaf's tokens.

    A node of weight 0 gets nothing.  The sums are exact: what the children
    get adds up to what the parent gives.
    """
    big = "decimal(38,0)"
    cap = leaves.select(F.lit(0).alias("root"), *levels, (F.col("tokens") * max_epochs).cast(big).alias("cap"))
    # a subtree's capacity counts only leaves that its weights can reach
    open_ = F.lit(True)
    for x in levels:
        open_ = open_ & (_weight(x, weights) > 0)
    cap = cap.withColumn("cap", F.when(open_, F.col("cap")).otherwise(F.lit(0).cast(big)))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"))
    parent = total.select(F.lit(0).alias("root"), F.expr(f"cast(t as {big}) * {int(share[0])} div {int(share[1])}").cast(big).alias("b"))
    above = ["root"]
    for x in levels:
        path = [*above, x]
        nodes = cap.groupBy(*path).agg(F.sum("cap").cast(big).alias("c")).withColumn("w", _weight(x, weights))
        nodes = nodes.where("w > 0 and c > 0")
        nodes = nodes.join(parent, above)
        up = Window.partitionBy(*above)
        order = up.orderBy((F.col("c").cast("double") / F.col("w").cast("double")), x)
        before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
        nodes = nodes.withColumn("b", F.least("b", F.sum("c").over(up).cast(big)))
        nodes = nodes.withColumns({
            "c0": F.coalesce(F.sum("c").over(before), F.lit(0)).cast(big), "w1": F.sum("w").over(up).cast(big),
            "w0": F.coalesce(F.sum("w").over(before), F.lit(0)).cast(big), "wc": F.sum("w").over(upto).cast(big)})
        # water level: full children come first in this order
        nodes = nodes.withColumn("full", F.col("c") * (F.col("w1") - F.col("w0")) <= (F.col("b") - F.col("c0")) * F.col("w"))
        nodes = nodes.withColumns({
            "cf": F.sum(F.when(F.col("full"), F.col("c")).otherwise(0)).over(up).cast(big),
            "wf": F.sum(F.when(F.col("full"), F.col("w")).otherwise(0)).over(up).cast(big)})
        # running quotients: each child within one token of its share, exact in sum
        part = F.expr(f"cast(((b - cf) * (wc - wf)) div (w1 - wf) - ((b - cf) * (w0 - wf)) div (w1 - wf) as {big})")
        parent = nodes.select(*path, F.when(F.col("full"), F.col("c")).otherwise(part).cast(big).alias("b"))
        above = path
    return leaves.join(parent, list(levels), "left").select(
        *levels, "tokens", F.coalesce(F.col("b"), F.lit(0)).cast("long").alias("given"))


def mix(docs: DataFrame, weights: Mapping[str, Mapping[str, int]] = WEIGHTS, domain: Column | None = None,
        share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
        keep: list[str] | None = None) -> DataFrame:
    """The chosen documents: ``keep`` columns of ``docs`` (all by default) in a
    struct ``row``, with ``domain, lang, source, tokens`` and ``copies``.

    Tokens are runs of characters other than ASCII white space.  A null level
    is the node ``(none)``; the domain of a null source too.  Null texts and
    texts without tokens weigh nothing: they come along with whole epochs or
    inside a prefix.  The document that crosses the end of a prefix is still
    taken.  Repeated rows count each for itself, ties in the order are broken
    by token number and text hash.  An empty table gives an empty result.
    Level names cannot clash with columns of ``docs``, which stay in ``row``.
    """
    none = F.lit("(none)")
    src = col(source_col).cast("string")
    ring = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(
        F.struct(*[col(c) for c in (docs.columns if keep is None else keep)]).alias("row"),
        F.coalesce(domain if domain is not None else domain_of(src), none).alias("domain"),
        F.coalesce(col(lang_col).cast("string"), none).alias("lang"), F.coalesce(src, none).alias("source"),
        words(col(text_col)).alias("tokens"), ring.alias("ring"), F.xxhash64(text_col).alias("tie"))
    rows = rows.withColumn("arc", F.conv(F.substring("ring", 1, 3), 16, 10).cast("int"))
    levels = list(LEVELS)
    slim = rows.select(*levels, "arc", "tokens")
    arcs = slim.groupBy(*levels, "arc").agg(F.sum("tokens").alias("arc_tokens"))
    leaves = arcs.groupBy(*levels).agg(F.sum("arc_tokens").alias("tokens"))
    given = allocate(leaves, LEVELS, weights, share, max_epochs).withColumns({
        "q": F.expr("if(tokens > 0, given div tokens, 0)"), "rest": F.expr("if(tokens > 0, given % tokens, 0)")})
    start = F.element_at(F.array(*[F.lit(x) for x in _offset(seed, max_epochs)]), F.col("q").cast("int") + 1)
    ringwise = Window.partitionBy(*levels).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        arcs.join(given.select(*levels, "q", "rest"), levels)
        .withColumn("at", F.pmod(F.col("arc") - start, F.lit(ARCS)))
        .withColumn("left", F.col("rest") - F.coalesce(F.sum("arc_tokens").over(ringwise), F.lit(0)))
        .where("q > 0 or left > 0")
        .select(*levels, "arc", "q", "left", "arc_tokens")
    )
    within = Window.partitionBy(*levels, "arc").orderBy("ring", "tokens", "tie").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(plan, [*levels, "arc"])
        .withColumn("before", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        .withColumn("copies", F.col("q") + F.when(F.col("before") < F.col("left"), 1).otherwise(0))
        .where("copies > 0")
        .select("row", *levels, "tokens", F.col("copies").cast("long").alias("copies"))
    )


def op10_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mix(docs, keep=["doc_id"]).select("row.doc_id", *LEVELS, "tokens", "copies")


def _case(level: str) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items()) + f" ELSE {DEFAULT_WEIGHT} END"


def _sql() -> str:
    """The same, for DuckDB."""
    out = [f"""r0 AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  regexp_extract(source, '([0-9]{{1,9}})$', 1) AS num, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ring FROM documents),
r AS (SELECT *, CASE WHEN num IS NULL THEN '(none)' WHEN num = '' THEN 'other' ELSE 'domain' || CAST(CAST(num AS INT) % {DOMAINS} AS VARCHAR) END AS domain,
  (instr('0123456789abcdef', substr(ring, 1, 1)) - 1) * 256 + (instr('0123456789abcdef', substr(ring, 2, 1)) - 1) * 16
  + instr('0123456789abcdef', substr(ring, 3, 1)) - 1 AS arc FROM r0),
arcs AS (SELECT domain, lang, source, arc, CAST(sum(tokens) AS HUGEINT) AS arc_tokens FROM r GROUP BY ALL),
leaves AS (SELECT domain, lang, source, sum(arc_tokens) AS tokens FROM arcs GROUP BY ALL),
b0 AS (SELECT CAST(coalesce(sum(tokens), 0) AS HUGEINT) * {SHARE[0]} // {SHARE[1]} AS b FROM leaves)"""]
    above: list[str] = []
    for n, x in enumerate(LEVELS, start=1):
        path = ", ".join([*above, x])
        join = f"JOIN b{n - 1} USING ({', '.join(above)})" if above else "CROSS JOIN b0"
        part = f"PARTITION BY {', '.join(above)}" if above else ""
        order = f"{part} ORDER BY CAST(c AS DOUBLE) / CAST(w AS DOUBLE), {x}"
        out.append(f"""n{n} AS (SELECT *, least(b, sum(c) OVER ({part})) AS bb,
  coalesce(sum(c) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(w) OVER ({part}) AS w1,
  coalesce(sum(w) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0,
  sum(w) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wc
  FROM (SELECT {path}, CAST(sum(tokens) * {MAX_EPOCHS} AS HUGEINT) AS c, CAST({_case(x)} AS HUGEINT) AS w FROM leaves GROUP BY {path}) {join} WHERE c > 0),
m{n} AS (SELECT *, c * (w1 - w0) <= (bb - c0) * w AS sat FROM n{n}),
o{n} AS (SELECT *, sum(CASE WHEN sat THEN c ELSE 0 END) OVER ({part}) AS cf, sum(CASE WHEN sat THEN w ELSE 0 END) OVER ({part}) AS wf FROM m{n}),
b{n} AS (SELECT {path}, CASE WHEN sat THEN c ELSE ((bb - cf) * (wc - wf)) // (w1 - wf) - ((bb - cf) * (w0 - wf)) // (w1 - wf) END AS b FROM o{n})""")
        above.append(x)
    lv = ", ".join(LEVELS)
    start = "CASE q " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_offset(SEED, MAX_EPOCHS))) + " END"
    out.append(f"""g AS (SELECT {lv}, b // tokens AS q, b % tokens AS rest FROM leaves JOIN b{len(LEVELS)} USING ({lv}) WHERE tokens > 0),
pl AS (SELECT *, rest - coalesce(sum(arc_tokens) OVER (PARTITION BY {lv} ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft
  FROM (SELECT *, (arc - {start} + {ARCS}) % {ARCS} AS spot FROM arcs JOIN g USING ({lv}))),
s AS (SELECT r.doc_id, {', '.join('r.' + x for x in LEVELS)}, r.tokens, q, lft,
  coalesce(sum(r.tokens) OVER (PARTITION BY {', '.join('r.' + x for x in LEVELS)}, r.arc ORDER BY ring, r.tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM r JOIN pl ON {' AND '.join(f'r.{x} = pl.{x}' for x in LEVELS)} AND r.arc = pl.arc)""")
    return "WITH " + ",\n".join(out) + f"""
SELECT doc_id, {lv}, tokens, CAST(q + CASE WHEN before < lft THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM s WHERE q + CASE WHEN before < lft THEN 1 ELSE 0 END > 0"""


OP10_SQL = _sql()
