"""Derive a rule suite from a table of column metadata, as a Spark job.

Metadata in (one row per column, catalog / information-schema shaped):

    column string, type string, nullable boolean, length int,
    ordinal long, constraints struct<regex string, min T, max T, enum array<string>>
    [, table string]

``T`` is any numeric type: bounds keep it (a long stays exact).

Rule table out (one row per derived rule), in three stages:

    1 Ingestion Quality            not-null if not nullable; regex if given
    2 Standardization              trim for VARCHAR/CHAR/STRING; then lower
                                   when the name contains 'email' or 'country'
    3 Business Logic Verification  min, max, set, length (VARCHAR/CHAR only,
                                   from 0 to the declared length)

Within a stage rules follow the metadata's column order, then the order
above.  Empty stages are absent.  Many tables' metadata can be derived at
once (``table`` column); ``Pipeline.from_rule_table`` turns one table's rules
into a runnable pipeline.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegralType, NumericType, StringType, StructType

from ..plans.pipeline import Pipeline

# Fixed values the derived suites must carry.
STAGE_NAMES = {1: "Ingestion Quality", 2: "Standardization", 3: "Business Logic Verification"}
STAGE_TYPES = {1: "dq", 2: "cleanse", 3: "dq"}
TEXT_TYPES = ["VARCHAR", "CHAR", "STRING"]
LENGTH_TYPES = ["VARCHAR", "CHAR"]
LOWERCASE_NAME_PARTS = ["email", "country"]


def _constraint(meta: DataFrame, name: str) -> Column:
    if "constraints" in meta.columns:
        t = meta.schema["constraints"].dataType
        if isinstance(t, StructType) and name in t.fieldNames():
            return F.col("constraints").getField(name)
    return F.lit(None)


def _bound_type(meta: DataFrame) -> DataType:
    """The numeric type of the bounds; double where both differ or none is given."""
    t = meta.schema["constraints"].dataType if "constraints" in meta.columns else None
    kinds = [t[n].dataType for n in ("min", "max") if isinstance(t, StructType) and n in t.fieldNames()]
    return kinds[0] if kinds and all(k == kinds[0] and isinstance(k, NumericType) for k in kinds) else DoubleType()


def profile_columns(df: DataFrame, patterns: Mapping[str, str] | None = None, enums: Mapping[str, list[str]] | None = None,
                    table: str | None = None) -> DataFrame:
    """Column metadata, the input of ``derive_rules``, measured on a table.

    One pass over ``df`` with plain aggregates: a column is nullable if it holds
    a NULL; text columns get the length of their longest value and integer
    columns their smallest and largest value.  ``patterns`` and ``enums`` add
    constraints by column.  An empty table gives its columns without bounds.
    """
    aggs, kinds = [F.count(F.lit(1)).alias("n")], {}
    for i, f in enumerate(df.schema.fields):
        c = F.col("`" + f.name.replace("`", "``") + "`")
        aggs.append(F.count(c).alias(f"c{i}"))
        if isinstance(f.dataType, StringType):
            kinds[i] = "VARCHAR"
            aggs.append(F.max(F.length(c)).alias(f"l{i}"))
        elif isinstance(f.dataType, IntegralType):
            kinds[i] = "BIGINT"
            aggs += [F.min(c).cast("long").alias(f"a{i}"), F.max(c).cast("long").alias(f"b{i}")]
        else:
            kinds[i] = f.dataType.simpleString().upper()

    def null(kind: str) -> Column:
        return F.lit(None).cast(kind)

    rows = []
    for i, f in enumerate(df.schema.fields):
        enum = (enums or {}).get(f.name)
        rows.append(F.struct(
            F.lit(i).cast("long").alias("ordinal"), F.lit(f.name).alias("column"), F.lit(kinds[i]).alias("type"),
            (F.col(f"c{i}") < F.col("n")).alias("nullable"),
            (F.col(f"l{i}").cast("int") if kinds[i] == "VARCHAR" else null("int")).alias("length"),
            F.struct(
                F.lit((patterns or {}).get(f.name)).cast("string").alias("regex"),
                (F.col(f"a{i}") if kinds[i] == "BIGINT" else null("long")).alias("min"),
                (F.col(f"b{i}") if kinds[i] == "BIGINT" else null("long")).alias("max"),
                (F.array(*[F.lit(x) for x in enum]) if enum else null("array<string>")).alias("enum"),
            ).alias("constraints")))
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    return out.withColumn("table", F.lit(table)) if table is not None else out


def derive_rules(meta: DataFrame) -> DataFrame:
    """Metadata table -> rule table (see module doc).  Runs distributed: each
    metadata row yields its candidate rules via one ``inline``; no driver loop."""
    if "ordinal" not in meta.columns:
        raise ValueError("the metadata needs an 'ordinal' column: rows of a table have no order of their own")
    name, typ = F.col("column"), F.col("type")
    length = F.col("length") if "length" in meta.columns else F.lit(None).cast("int")
    regex = _constraint(meta, "regex").cast("string")
    bound = _bound_type(meta)
    lo = _constraint(meta, "min").cast(bound)
    hi = _constraint(meta, "max").cast(bound)
    enum = _constraint(meta, "enum").cast("array<string>")
    is_text = typ.isin(*TEXT_TYPES)
    lower_name = F.lit(False)
    for part in LOWERCASE_NAME_PARTS:
        lower_name = lower_name | name.contains(part)

    def rule(stage: int, pos: int, keep: Column, rtype: str, rid: Column | None, **p: Column) -> Column:
        fields = {
            "stage_no": F.lit(stage),
            "rule_pos": F.lit(pos),
            "keep": F.coalesce(keep, F.lit(False)),
            "id": rid if rid is not None else F.lit(None).cast("string"),
            "type": F.lit(rtype),
            "pattern": p.get("pattern", F.lit(None).cast("string")),
            "value": p.get("value", F.lit(None).cast(bound)),
            "values": p.get("values", F.lit(None).cast("array<string>")),
            "min_len": p.get("min_len", F.lit(None).cast("int")),
            "max_len": p.get("max_len", F.lit(None).cast("int")),
        }
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    def rid(suffix: str) -> Column:
        return F.concat(F.lit("dq_"), name, F.lit("_" + suffix))

    candidates = F.array(
        # a NULL 'nullable' is not a promise of nullability: emit the check
        rule(1, 1, F.coalesce(~F.col("nullable"), F.lit(True)), "check_not_null", rid("not_null")),
        rule(1, 2, regex.isNotNull(), "check_regex", rid("regex"), pattern=regex),
        rule(2, 3, is_text, "clean_trim", None),
        rule(2, 4, is_text & lower_name, "clean_lowercase", None),
        rule(3, 5, lo.isNotNull(), "check_min", rid("min"), value=lo),
        rule(3, 6, hi.isNotNull(), "check_max", rid("max"), value=hi),
        rule(3, 7, enum.isNotNull(), "check_in_set", rid("valid_set"), values=enum),
        rule(3, 8, length.isNotNull() & typ.isin(*LENGTH_TYPES), "check_length", rid("len"),
             min_len=F.lit(0), max_len=length.cast("int")),
    )
    table = [F.col("table")] if "table" in meta.columns else []
    stage_name = F.element_at(F.create_map(*[x for k, v in STAGE_NAMES.items() for x in (F.lit(k), F.lit(v))]), F.col("stage_no"))
    stage_type = F.element_at(F.create_map(*[x for k, v in STAGE_TYPES.items() for x in (F.lit(k), F.lit(v))]), F.col("stage_no"))
    out = meta.select(*table, F.col("ordinal"), name.alias("column"), F.inline(candidates)).where(F.col("keep"))
    return out.select(
        *table,
        "stage_no",
        stage_name.alias("stage_name"),
        stage_type.alias("stage_type"),
        "ordinal",
        "rule_pos",
        "id",
        "type",
        "column",
        "pattern",
        "value",
        "values",
        "min_len",
        "max_len",
    )


def suite_pipeline(meta: DataFrame, table: str | None = None, **kw) -> Pipeline:
    """Derive and compile one table's suite (the rules, not the data, go to the driver)."""
    rules = derive_rules(meta)
    if table is not None:
        rules = rules.where(F.col("table") == table).drop("table")
    return Pipeline.from_rule_table(rules, **kw)
