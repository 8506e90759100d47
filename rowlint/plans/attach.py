"""Rules whose verdict needs more than the row itself.

Each of them reduces what it needs (a reference table, or the checked table)
to a narrow side table with at most one match for any row, and left-joins it.  So
the row count never changes, and only the rule's own columns are read on the
side.  No broadcast hint: Spark broadcasts the side where its size is measured
under the threshold, and otherwise plans a sort-merge join.

Every such join has one more key, a salt.  Rows whose key is NULL can have no
match and are spread by it over the tasks.  The side holds its salt as the
result of an aggregate, so that both inputs of the join are plain exchanges,
which adaptive execution can split where one key is hot.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Any, Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, NullType, NumericType, StringType, StructType, TimestampNTZType, TimestampType

from ..functions.checks import RuleTypeError
from ..functions.registry import DEFAULT_REGISTRY, Param, RuleDef

NULL_SALTS = 64
KEY_SALTS = 8
_TIME = (DateType, TimestampType, TimestampNTZType)


@dataclass
class Binding:
    """A rule at its place in a pipeline: the rows so far and how to name and find things."""

    df: DataFrame
    rule: Any
    value: Column
    dtype: DataType
    column_of: Callable[[str], tuple[Column, DataType]]  # a column of the rows
    table_of: Callable[[str], DataFrame]  # a reference table
    table_column: Callable[[DataFrame, str], tuple[Column, DataType]]
    fresh: Callable[[str], str]  # an unused column name
    rule_def: Callable[[str, str], RuleDef] | None = None  # rule types by kind and name
    positions: str | None = None  # set by a rule on elements: the column of failing positions
    shape: tuple[str, StructType, str] | None = None  # set by a rule on JSON text: the parsed column, its type, its corrupt record
    taken: dict[str, tuple[str, StructType, str]] = field(default_factory=dict)  # shapes so far, by column

    @property
    def params(self) -> dict[str, Any]:
        return self.rule.kwargs()


def any_null(keys: Sequence[Column]) -> Column:
    return reduce(or_, [k.isNull() for k in keys])


def row_salt(b: Binding, keys: Sequence[Column]) -> Column:
    """0, or for a row whose key is NULL one of ``NULL_SALTS`` others.

    From the rule's ``salt_columns``, else drawn by ``rand``: the verdict does not
    depend on it and no further column is read.
    """
    names = b.params.get("salt_columns")
    if names:
        draw = F.pmod(F.xxhash64(*[b.column_of(n)[0] for n in names]), F.lit(NULL_SALTS))
    else:
        draw = F.floor(F.rand(17) * NULL_SALTS)
    return F.when(any_null(keys), draw.cast("int") + 1).otherwise(F.lit(0))


def _batch_only(b: Binding) -> None:
    if b.df.isStreaming:
        raise RuleTypeError(f"{b.rule.type} looks at the whole table: a stream has none (see streaming.unique_within, streaming.matched_within)")


def looked_up(b: Binding, keys: Sequence[Column], side: DataFrame, names: Sequence[str], salt: str, outputs: Sequence[str],
              extra: Column | None = None, own_salt: Column | None = None) -> DataFrame:
    """The rows with ``outputs`` of the side row that equals them in ``keys`` (the
    side's ``names``) and holds ``extra``; NULL where there is none."""
    mine = b.fresh("row_salt")
    rows = b.df.withColumn(mine, row_salt(b, keys) if own_salt is None else own_salt)
    on = reduce(and_, [k == F.col(n) for k, n in zip(keys, names)] + [F.col(mine) == F.col(salt)])
    joined = rows.join(side, on if extra is None else on & extra, "left")
    return joined.drop(mine, salt, *[n for n in names if n not in outputs])


# -- membership in a table ---------------------------------------------------
def in_table(b: Binding) -> tuple[DataFrame, Column]:
    """PASS iff the value is a key of the table.

    The side is the table's distinct keys, cast to the checked column's type; a
    key that does not come back equal from that type cannot be met and is
    dropped.
    """
    key, hit, salt = b.fresh("key"), b.fresh("hit"), b.fresh("salt")
    ref = b.table_of(b.params["table"])
    raw, ktype = b.table_column(ref, b.params.get("key") or b.rule.column)
    side = (
        ref.select(raw.try_cast(b.dtype).alias(key), raw.alias("__raw"))
        .where(F.col(key).isNotNull() & (F.col(key).try_cast(ktype) == F.col("__raw")))
        .groupBy(key).agg(F.max(F.lit(0)).alias(salt), F.max(F.lit(True)).alias(hit))
    )
    return looked_up(b, [b.value], side, [key], salt, [hit]), F.col(hit)


# -- uniqueness --------------------------------------------------------------
def unique(b: Binding) -> tuple[DataFrame, Column]:
    """PASS iff no other row has the same key: the value, with those of ``columns``.

    A key with a NULL is FAIL.  The keys are counted with partial sums per task,
    so a hot key crosses the exchange once per task; only repeated keys go on
    to the join.  Rows meet them by (key, salt): a row draws one of ``KEY_SALTS``
    salts and a repeated key stands under each, so a hot key's rows are dealt to
    that many tasks, which adaptive execution may split further.  ``digest``
    compares SHA-256 digests, for keys that are whole texts.
    """
    p = b.params
    _batch_only(b)
    raw = keys = [b.value] + [b.column_of(n)[0] for n in p.get("columns") or []]
    if p.get("digest"):
        keys = [F.sha2(k.cast("string"), 256) for k in raw]
    names = [b.fresh(f"key{i}") for i in range(len(keys))]
    hit, salt = b.fresh("hit"), b.fresh("salt")
    counts = b.df.select(*[k.alias(n) for k, n in zip(keys, names)]).where(~any_null([F.col(n) for n in names]))
    repeated = counts.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), F.max(F.lit(True)).alias(hit)).where("__n > 1")
    side = repeated.select(*names, hit, F.explode(F.sequence(F.lit(0), F.lit(KEY_SALTS - 1))).alias(salt))
    by_columns = p.get("salt_columns")
    draw = F.xxhash64(*[b.column_of(n)[0] for n in by_columns]) if by_columns else F.floor(F.rand(17) * KEY_SALTS)
    spread = F.when(any_null(raw), row_salt(b, raw) + KEY_SALTS).otherwise(F.pmod(draw, F.lit(KEY_SALTS)).cast("int"))
    # named before the join, so that a digest is taken once
    kept = [b.fresh(f"mine{i}") for i in range(len(keys))]
    b.df = b.df.withColumns({n: k for n, k in zip(kept, keys)})
    out = looked_up(b, [F.col(n) for n in kept], side, names, salt, [hit], own_salt=spread)
    return out.drop(*kept), ~any_null(raw) & F.col(hit).isNull()


# -- numbers and times on one axis ---------------------------------------------
def _kind(dtype: DataType, rule: str) -> str:
    if isinstance(dtype, NumericType):
        return "number"
    if isinstance(dtype, _TIME):
        return "time"
    raise RuleTypeError(f"{rule} needs a number, date or timestamp, got {dtype.simpleString()}")


def _comparable(c: Column, dtype: DataType) -> Column:
    return c if isinstance(dtype, NumericType) else c.cast("timestamp_ntz")


def micros(t: Column) -> Column:
    """Microseconds of a ``timestamp_ntz`` by the wall clock, whatever the session's zone."""
    day = F.unix_date(t.cast("date")).cast("long") * 86400
    return (day + F.hour(t) * 3600 + F.minute(t) * 60) * 1000000 + (F.date_part(F.lit("SECOND"), t) * 1000000).cast("long")


def _axis(c: Column, dtype: DataType) -> Column:
    """A number that grows with the value: seconds for times."""
    return c.cast("double") if isinstance(dtype, NumericType) else micros(_comparable(c, dtype)) / F.lit(1000000.0)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


# -- intervals of a table ------------------------------------------------------
def interval(b: Binding) -> tuple[DataFrame, Column]:
    """PASS iff the value lies in one of the table's intervals, ``start`` to ``end``
    (``closed``: ``both`` ends, or ``left`` only), for equal ``on`` columns if given.

    ``bin`` (in the value's unit; seconds for dates and timestamps) divides the
    axis; an interval stands in each bin it touches, rows look into their own
    bin, and the exact test follows.  Within a bin overlapping intervals are
    united, so at most one holds a value.  Intervals that began in an earlier
    bin become one row before any exchange.  A NULL value or ``on`` key is FAIL;
    NULL or reversed bounds hold nothing.
    """
    p = b.params
    table = b.table_of(p["table"])
    lo, lo_type = b.table_column(table, p["start"])
    hi, hi_type = b.table_column(table, p["end"])
    kinds = {_kind(t, "check_interval") for t in (b.dtype, lo_type, hi_type)}
    if len(kinds) > 1:
        raise RuleTypeError(f"check_interval: {b.dtype.simpleString()} values, bounds {lo_type.simpleString()} and {hi_type.simpleString()}")
    width = float(p["bin"])
    left = (p.get("closed") or "both") == "left"
    on = [x.split("=") if "=" in x else (x, x) for x in p.get("on") or []]
    mine = [b.column_of(m)[0] for m, _ in on]
    theirs = [b.table_column(table, t)[0] for _, t in on]
    keys = [b.fresh(f"on{i}") for i in range(len(on))]
    bin_, at, to, salt = b.fresh("bin"), b.fresh("from"), b.fresh("to"), b.fresh("salt")

    def slot(c: Column, dtype: DataType) -> Column:
        axis = _axis(c, dtype)
        return F.when(_finite(axis), F.floor(axis / width))

    rows = table.select(*[t.alias(k) for t, k in zip(theirs, keys)], _comparable(lo, lo_type).alias(at), _comparable(hi, hi_type).alias(to),
                        slot(lo, lo_type).alias("__b0"), slot(hi, hi_type).alias("__b1"))
    valid = (F.col(at) < F.col(to)) if left else (F.col(at) <= F.col(to))
    rows = rows.where(valid & F.col("__b0").isNotNull() & F.col("__b1").isNotNull() & (~any_null([F.col(k) for k in keys]) if keys else F.lit(True)))
    spread = rows.select(*keys, at, to, "__b0", F.explode(F.sequence("__b0", "__b1")).alias(bin_))
    began = F.when(F.col("__b0") == F.col(bin_), F.col(at))  # NULL: in an earlier bin
    parts = spread.groupBy(*keys, bin_, began.alias("__began")).agg(F.min(at).alias(at), F.max(to).alias(to))
    order = Window.partitionBy(*keys, bin_).orderBy(at, to)
    reach = F.max(to).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col(at) > reach), 1).otherwise(0)
    united = parts.withColumn("__open", opens).withColumn("__island", F.sum("__open").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    side = united.groupBy(*keys, bin_, "__island").agg(F.min(at).alias(at), F.max(to).alias(to), F.max(F.lit(0)).alias(salt)).drop("__island")
    value, here = b.fresh("value"), b.fresh("here")
    b.df = b.df.withColumns({value: _comparable(b.value, b.dtype), here: slot(b.value, b.dtype)})
    v = F.col(value)
    inside = (F.col(at) <= v) & ((v < F.col(to)) if left else (v <= F.col(to)))
    out = looked_up(b, [*mine, F.col(here)], side, [*keys, bin_], salt, [at, to], extra=inside).drop(value, here, to)
    return out, F.col(at).isNotNull()


# -- sequences -------------------------------------------------------------------
def sequence(b: Binding) -> tuple[DataFrame, Column]:
    """PASS iff the value follows its predecessor as it should: within the rows of
    equal ``by`` columns, in the order of ``order`` (the value itself if not given),
    the step from the one before is from ``min_step`` to ``max_step`` (1 to 1 if
    neither is given; seconds for times; a side left out is open).

    Rows that share a place in the order are judged together: they are a repeat,
    which is FAIL unless ``repeats``, and the steps around them count from their
    largest and to their smallest value.  The first of a key passes, or if
    ``first`` is given only with that value.  A NULL value, order or key is FAIL.

    Places are counted before anything else, so repeats of a place are one row.
    ``span`` cuts the order axis into stretches: a key's places are ordered
    stretch by stretch, each in a group of its own, and the last place of a
    stretch is carried to the first of the next one; a key of any length is thus
    checked in parallel.  Only the places that fail are joined back.
    """
    p = b.params
    _batch_only(b)
    kind = _kind(b.dtype, "check_sequence")
    lo_step, hi_step = p.get("min_step"), p.get("max_step")
    if lo_step is None and hi_step is None:
        lo_step = hi_step = 1
    unit = 1 if kind == "number" else 1000000
    by = [b.column_of(n)[0] for n in p["by"]]
    orders = [b.column_of(p["order"])] if p.get("order") else [(b.value, b.dtype)]
    order, order_type = orders[0]
    names = [b.fresh(f"by{i}") for i in range(len(by))]
    place, hit, salt = b.fresh("place"), b.fresh("hit"), b.fresh("salt")
    exact = b.value if kind == "number" else micros(_comparable(b.value, b.dtype))
    rows = b.df.select(*[c.alias(n) for c, n in zip(by, names)], order.alias(place), exact.alias("__v"))
    rows = rows.where(~any_null([F.col(c) for c in (*names, place, "__v")]))
    places = rows.groupBy(*names, place).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    stretch = F.lit(0)
    if p.get("span") is not None:
        _kind(order_type, "check_sequence with span")
        stretch = F.floor(_axis(F.col(place), order_type) / float(p["span"]))
    places = places.withColumn("__s", stretch)

    def bad(prev_hi: Column) -> Column:
        first = p.get("first")
        step = F.col("__lo") - prev_hi
        wrong = F.lit(False)
        if lo_step is not None:
            wrong = wrong | (step < F.lit(lo_step * unit))
        if hi_step is not None:
            wrong = wrong | (step > F.lit(hi_step * unit))
        at_start = F.lit(False) if first is None else ~(F.col("__lo") == F.lit(first * unit))
        wrong = F.when(prev_hi.isNull(), at_start).otherwise(wrong)
        return wrong if p.get("repeats") else wrong | (F.col("__n") > 1)

    inside = Window.partitionBy(*names, "__s").orderBy(place)
    within = places.withColumn("__prev", F.lag("__hi").over(inside)).where(F.col("__prev").isNotNull() & bad(F.col("__prev"))).select(*names, place)
    parts = F.struct(place, "__n", "__lo", "__hi")
    ends = places.groupBy(*names, "__s").agg(F.min(parts).alias("__first"), F.max(F.struct(place, "__hi")).alias("__last"))
    carried = F.lag("__last").over(Window.partitionBy(*names).orderBy("__s"))
    starts = ends.withColumn("__prev", carried["__hi"]).select(*names, "__first.*", "__prev")
    edges = starts.where(bad(F.col("__prev"))).select(*names, place)
    side = within.unionAll(edges).groupBy(*names, place).agg(F.max(F.lit(0)).alias(salt), F.max(F.lit(True)).alias(hit))
    keys = [*by, order]
    out = looked_up(b, keys, side, [*names, place], salt, [hit])
    return out, ~any_null([*keys, b.value]) & F.col(hit).isNull()


# -- JSON text -------------------------------------------------------------------
def json_shape(b: Binding) -> tuple[DataFrame, Column]:
    """PASS iff the text is a JSON object that fits ``schema`` (DDL, as in ``k int, user
    struct<name string>``): every field that is there has its type.

    The text is parsed once, permissively, into a hidden column; a record that
    does not fit comes back as corrupt.  Later rules reach what was parsed as
    ``column->path``.  Missing and further fields are no fault (check the path for
    NULL); NULL, empty and blank text, arrays and scalars are FAIL.
    """
    if not isinstance(b.dtype, (StringType, NullType)):
        raise RuleTypeError(f"check_json needs text, got {b.dtype.simpleString()}")
    try:
        shape = StructType.fromDDL(b.params["schema"])
    except Exception as e:
        raise RuleTypeError(f"check_json: schema {b.params['schema']!r} is no list of fields: {str(e).splitlines()[0]}") from e
    known = b.taken.get(b.rule.column)
    if known and known[1] == shape:
        b.shape = known
    else:
        corrupt = "_corrupt_record"
        while corrupt in shape.fieldNames():
            corrupt = "_" + corrupt
        name = b.fresh("json")
        whole = StructType([*shape.fields]).add(corrupt, StringType())
        parsed = F.from_json(b.value.cast("string"), whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
        b.df = b.df.withColumn(name, parsed)  # a column of its own, so that it is parsed once
        b.shape = (name, shape, corrupt)
    record = F.col(b.shape[0])
    return b.df, record.isNotNull() & record[b.shape[2]].isNull() & F.regexp_like(b.value, F.lit(r"^\s*\{"))


# -- elements of an array ----------------------------------------------------------
def each(b: Binding) -> tuple[DataFrame, Column]:
    """PASS iff the rule ``rule`` (with ``args``) passes for every element of the array,
    or for its ``field`` where elements are structs.

    A NULL element fails as a NULL value does; an empty array passes, a NULL one
    fails.  The rule's Column is lifted into a lambda, so no row is exploded.  The
    places of the failing elements (from 0) are kept beside the verdict.
    """
    p = b.params
    if not isinstance(b.dtype, ArrayType):
        raise RuleTypeError(f"check_each needs an array, got {b.dtype.simpleString()}")
    rdef = b.rule_def("dq", p["rule"])
    if rdef.attach:
        raise RuleTypeError(f"check_each cannot lift {p['rule']}: it needs more than the element")
    kind, path = b.dtype.elementType, [x for x in (p.get("field") or "").split(".") if x]
    for part in path:
        if not isinstance(kind, StructType) or part not in kind.fieldNames():
            raise RuleTypeError(f"check_each: elements of type {b.dtype.elementType.simpleString()} have no field {p['field']!r}")
        kind = kind[part].dataType
    args = dict(p.get("args") or {})

    def bad(x: Column) -> Column:
        at = reduce(lambda c, f: c[f], path, x)
        return ~F.coalesce(rdef.build(at, kind, **args), F.lit(False))

    name = b.fresh("places")
    b.df = b.df.withColumn(name, F.filter(F.transform(b.value, lambda x, i: F.when(bad(x), i)), lambda i: i.isNotNull()))
    b.positions = name
    return b.df, b.value.isNotNull() & ~F.exists(b.value, bad)


def _lifted(p: dict[str, Any]) -> list[str]:
    rdef = DEFAULT_REGISTRY.lookup("dq", p["rule"])  # a rule type of another registry is looked up at compile
    args = p.get("args") or {}
    if not hasattr(args, "keys"):
        return ["check_each: args must be a mapping"]
    if rdef is None or rdef.attach:
        return []
    problems = [f"check_each: {p['rule']} has no parameter {k!r}" for k in args if k not in rdef.param_names()]
    problems += [f"check_each: {p['rule']} needs {q.name!r}" for q in rdef.params if q.required and q.name not in args]
    return problems + (rdef.check(dict(args)) if rdef.check and not problems else [])


def _steps(p: dict[str, Any]) -> list[str]:
    lo, hi = p.get("min_step"), p.get("max_step")
    problems = [f"check_sequence: min_step {lo} is above max_step {hi}"] if lo is not None and hi is not None and lo > hi else []
    if not p.get("by"):
        problems.append("check_sequence: 'by' is empty")
    return problems + _positive(p, "span", "check_sequence")


def _positive(p: dict[str, Any], name: str, rule: str) -> list[str]:
    v = p.get(name)
    return [f"{rule}: {name} must be above 0"] if v is not None and not v > 0 else []


def _intervals(p: dict[str, Any]) -> list[str]:
    problems = _positive(p, "bin", "check_interval")
    if p.get("closed") not in (None, "both", "left"):
        problems.append("check_interval: closed must be 'both' or 'left'")
    return problems


def _not_a_column(*_a, **_k):  # pragma: no cover - compile attaches instead
    raise RuleTypeError("this rule is evaluated by a join at compile time")


_SALT = Param("salt_columns", "list", required=False)

for _name, _attach, _params, _check in (
    ("check_in_table", in_table, (Param("table", "str"), Param("key", "str", required=False), _SALT), None),
    ("check_unique", unique, (Param("columns", "list", required=False), Param("digest", "any", required=False), _SALT), None),
    ("check_interval", interval, (Param("table", "str"), Param("start", "str"), Param("end", "str"), Param("bin", "number"),
                                  Param("on", "list", required=False), Param("closed", "str", required=False), _SALT), _intervals),
    ("check_sequence", sequence, (Param("by", "list"), Param("order", "str", required=False), Param("min_step", "number", required=False),
                                  Param("max_step", "number", required=False), Param("first", "number", required=False),
                                  Param("repeats", "any", required=False), Param("span", "number", required=False), _SALT), _steps),
    ("check_json", json_shape, (Param("schema", "str"),), None),
    ("check_each", each, (Param("rule", "str"), Param("args", "any", required=False), Param("field", "str", required=False)), _lifted),
):
    DEFAULT_REGISTRY.add(RuleDef(_name, "dq", _not_a_column, _params, _check, attach=_attach))
