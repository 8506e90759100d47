"""Compile a validated spec against a DataFrame's schema into projections.

Shape of the plan (one pass over the data, no shuffle, no Python per row):

1. each ``dq`` stage adds one boolean column per rule in a single
   ``withColumns``; the value checked is the value *at that stage*, so a
   later cleanse cannot change an earlier verdict (snapshot semantics);
2. each ``cleanse`` stage is a single ``withColumns``; rules on the same
   column compose in listed order;
3. only the requested output builds on top: the reference-shaped result map
   (one ``create_map`` over all rules; an incoming map is kept with one
   ``map_concat``), flat verdict columns, one row per finding, or a summary
   of conditional aggregates.

Because verdicts stay separate columns until the end, column pruning drops
every rule a report does not ask for, and a summary never builds a map.
"""

from __future__ import annotations

import copy
import warnings
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Iterable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from ..functions.checks import RuleTypeError
from ..functions.registry import DEFAULT_REGISTRY, Registry
from .attach import Binding
from .spec import PipelineSpec, SpecError, SpecWarning

RESULTS_COL = "_dq_results"
PASS, FAIL = "PASS", "FAIL"
MAP_FORMS = ("entries", "arrays")
ON_RECHECK = ("replace", "error")


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_at(path: Sequence[str]) -> Column:
    return reduce(lambda c, f: c.getField(f), path[1:], F.col(quote(path[0])))


def status_of(flag: Column) -> Column:
    """Boolean verdict to text; NULL never reaches here (see ``_build``)."""
    return F.when(flag, F.lit(PASS)).otherwise(F.lit(FAIL))


def append_results(prev: Column, new: Column, replaced: Sequence[str]) -> Column:
    """``new`` verdicts after those of ``prev``, which loses the ``replaced`` ids."""
    kept = F.map_filter(prev, lambda k, v: ~k.isin(list(replaced))) if replaced else prev
    return F.map_concat(kept, new)


def _find(struct: StructType, name: str, case_sensitive: bool):
    for f in struct.fields:
        if f.name == name:
            return f
    if case_sensitive:
        return None
    hits = [f for f in struct.fields if f.name.lower() == name.lower()]
    if len(hits) > 1:
        raise SpecError([f"column {name!r} is ambiguous: {[f.name for f in hits]}"])
    return hits[0] if hits else None


def resolve(schema: StructType, name: str, case_sensitive: bool = False) -> tuple[list[str], DataType]:
    """Column name (top-level, possibly with dots, or a struct path) to the
    schema's own spelling of the path and the field type."""
    top = _find(schema, name, case_sensitive)
    if top is not None:
        return [top.name], top.dataType
    path, dtype = [], schema
    for part in name.split("."):
        if not isinstance(dtype, StructType):
            where = ".".join(path) or name
            kind = "an array" if isinstance(dtype, ArrayType) else dtype.simpleString()
            raise SpecError([f"column {name!r}: {where} is {kind}, not a struct"])
        f = _find(dtype, part, case_sensitive)
        if f is None:
            raise SpecError([f"column {name!r} not found; have {[x.name for x in schema.fields]}"])
        path.append(f.name)
        dtype = f.dataType
    return path, dtype


_VALID_PATTERNS: set[str] = set()  # patterns Spark already compiled in this process


def invalid_patterns(spark, pats: Sequence[tuple[str, str]]) -> list[str]:
    """``(rule id, pattern)`` pairs Spark's regex engine rejects, as problems.

    Tried on an inline table (a local relation: no Spark job runs), once per
    distinct pattern per process, so a bad pattern fails the plan instead of a
    task hours into a large job.  Only Spark's own complaint about a pattern
    counts; any other error is raised."""
    todo = [(rid, p) for rid, p in pats if p not in _VALID_PATTERNS]
    if not todo:
        return []

    def fails(ps) -> bool:
        tries = ", ".join(f"s RLIKE :p{i} AS p{i}" for i in range(len(ps)))
        try:
            spark.sql(f"SELECT {tries} FROM VALUES ('') AS t(s)", args={f"p{i}": p for i, (_, p) in enumerate(ps)}).collect()
            return False
        except PySparkException as e:
            if not (e.getCondition() or "").startswith("INVALID_PARAMETER_VALUE.PATTERN"):
                raise
            return True

    if not fails(todo):
        _VALID_PATTERNS.update(p for _, p in todo)
        return []
    bad = []
    for rid, p in todo:
        if fails([(rid, p)]):
            bad.append(f"rule {rid}: invalid regex {p!r}")
        else:
            _VALID_PATTERNS.add(p)
    return bad


@dataclass(frozen=True)
class CompiledRule:
    id: str
    type: str
    column: str
    stage: str
    stage_no: int
    flag: str  # hidden boolean column holding the verdict

    @property
    def status(self) -> Column:
        return status_of(F.col(self.flag))


class CompiledPipeline:
    """A spec bound to one input DataFrame.  Every method is lazy, and binding
    runs no Spark job.

    ``map_form`` says how the result map is built, whatever the number of
    rules: ``"entries"`` (one entry per rule; a report that reads one verdict
    reads only that rule's columns) or ``"arrays"`` (a constant key array and a
    lambda over the flags: less generated code for suites of hundreds of rules).
    ``on_recheck`` says what happens to an incoming verdict of an id that this
    pipeline checks again: ``"replace"`` it, or ``"error"`` when the rows are read.
    """

    def __init__(
        self,
        spec: PipelineSpec,
        df: DataFrame,
        registry: Registry | None = None,
        results_col: str = RESULTS_COL,
        tables: Mapping[str, DataFrame] | None = None,
        map_form: str = "entries",
        on_recheck: str = "replace",
    ):
        if map_form not in MAP_FORMS or on_recheck not in ON_RECHECK:
            raise ValueError(f"map_form must be one of {MAP_FORMS}, on_recheck one of {ON_RECHECK}")
        self.map_form, self.on_recheck = map_form, on_recheck
        self.spec = spec
        self.tables = dict(tables or {})
        self.registry = registry or DEFAULT_REGISTRY
        self.results_col = results_col
        self.input_columns = list(df.columns)
        self.notes: list[str] = []
        try:
            cs = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
        except Exception:  # pragma: no cover - conf access can fail on some clients
            cs = False
        self.case_sensitive = cs
        self.incoming = results_col in self.input_columns
        if self.incoming:
            t = df.schema[results_col].dataType
            if not (isinstance(t, MapType) and isinstance(t.keyType, StringType) and isinstance(t.valueType, StringType)):
                raise SpecError([f"input column {results_col!r} is {t.simpleString()}, not map<string,string>"])
        self.rules: list[CompiledRule] = []
        self._shapes: dict[str, tuple[str, StructType, str]] = {}  # parsed JSON text, by column
        self._places: dict[str, str] = {}  # failing positions, by rule
        self._staged = self._build(df)

    # -- building --------------------------------------------------------
    def _hidden(self, taken: set[str]) -> str:
        n = len(self.rules)
        name = f"__dq_{n}"
        while name in taken:
            name = "_" + name
        return name

    def _build(self, df: DataFrame) -> DataFrame:
        problems: list[str] = []
        taken = set(self.input_columns)
        # the schema rules resolve against is tracked here, not re-read from
        # the JVM after every stage: verdict columns are not targets, and a
        # cleanse changes only the types it reports
        schema = df.schema
        for no, stage in enumerate(self.spec.stages, start=1):
            if stage.type == "dq":
                new: dict[str, Column] = {}
                for rule in stage.rules:
                    try:
                        path, dtype = self._target(schema, rule.column)
                        rdef = self._rule_def("dq", rule.type)
                        if rdef.attach:
                            df, pred = self._attach(df, schema, rule, rdef, path, dtype, taken)
                        else:
                            pred = rdef.build(column_at(path), dtype, **rule.kwargs())
                    except (SpecError, RuleTypeError) as e:
                        problems.extend(getattr(e, "problems", [str(e)]))
                        continue
                    flag = self._hidden(taken)
                    taken.add(flag)
                    # NULL is FAIL: fold it here so the flag is two-valued
                    new[flag] = F.coalesce(pred, F.lit(False))
                    self.rules.append(CompiledRule(rule.id, rule.type, rule.column, stage.name, no, flag))
                if new and not problems:
                    df = df.withColumns(new)
            else:
                types: dict[tuple[str, ...], DataType] = {}
                exprs = self._cleanse_exprs(stage, schema, problems, types)
                if exprs and not problems:
                    df = df.withColumns(exprs)
                    for rule in stage.rules:  # the text that was parsed is another one now
                        self._shapes.pop(rule.column, None)
                    if any(len(k) > 1 for k in types):
                        schema = StructType([f for f in df.schema.fields if f.name in set(schema.fieldNames())])
                    else:
                        schema = StructType([
                            StructField(f.name, types.get((f.name,), f.dataType), f.nullable, f.metadata)
                            for f in schema.fields
                        ])
        if not problems:
            pats = [(r.id, r.kwargs()["pattern"]) for st in self.spec.stages if st.type == "dq"
                    for r in st.rules if r.type == "check_regex"]
            pats += [(r.id, r.kwargs()["args"]["pattern"]) for st in self.spec.stages if st.type == "dq"
                     for r in st.rules if r.type == "check_each" and r.kwargs()["rule"] == "check_regex"]
            if pats:
                problems.extend(invalid_patterns(df.sparkSession, pats))
        if problems:
            raise SpecError(problems)
        for n in self.notes:
            warnings.warn(n, SpecWarning, stacklevel=3)
        return df

    def _rule_def(self, kind: str, name: str):
        rdef = self.registry.lookup(kind, name)
        if rdef is None:
            raise SpecError([f"no {kind} rule type {name!r} in this pipeline's registry"])
        return rdef

    def _attach(self, df: DataFrame, schema: StructType, rule, rdef, path, dtype, taken: set[str]) -> tuple[DataFrame, Column]:
        """The rows with what a rule of ``plans.attach`` joins in, and its predicate."""
        n = len(self.rules)

        def fresh(what: str) -> str:
            name = f"__{what}_{n}"
            while name in taken:
                name = "_" + name
            taken.add(name)
            return name

        def table_of(name: str) -> DataFrame:
            if name in self.tables:
                return self.tables[name]
            try:
                return df.sparkSession.table(name)
            except Exception as e:
                raise SpecError([f"rule {rule.id}: no table {name!r} (pass tables={{...}} to compile)"]) from e

        def found(schema: StructType, name: str) -> tuple[Column, DataType]:
            at, kind = resolve(schema, name, self.case_sensitive)
            return column_at(at), kind

        b = Binding(df, rule, column_at(path), dtype, lambda c: found(schema, c), table_of, lambda t, c: found(t.schema, c), fresh,
                    self._rule_def, taken=self._shapes)
        df, pred = rdef.attach(b)
        if b.positions:
            self._places[rule.id] = b.positions
        if b.shape:
            self._shapes[rule.column] = b.shape
        return df, pred

    def _target(self, schema: StructType, name: str) -> tuple[list[str], DataType]:
        if "->" in name and _find(schema, name, self.case_sensitive) is None:
            base, inner = (x.strip() for x in name.split("->", 1))
            if base not in self._shapes:
                raise SpecError([f"column {name!r}: no check_json rule before it tells the shape of {base!r}"])
            hidden, shape, _ = self._shapes[base]
            path, dtype = resolve(shape, inner, self.case_sensitive)
            return [hidden, *path], dtype
        path, dtype = resolve(schema, name, self.case_sensitive)
        if path[0] == self.results_col:
            raise SpecError([f"rules cannot target the result column {self.results_col!r}"])
        return path, dtype

    def _cleanse_exprs(self, stage, schema: StructType, problems: list[str],
                       types: dict[tuple[str, ...], DataType]) -> dict[str, Column]:
        # rules on one column compose in listed order; columns keep first-seen order
        chains: dict[tuple[str, ...], tuple[Column, DataType]] = {}
        for rule in stage.rules:
            try:
                if "->" in rule.column:
                    raise SpecError([f"cannot cleanse {rule.column}: a path in JSON text"])
                path, dtype = self._target(schema, rule.column)
                key = tuple(path)
                expr, cur = chains.get(key, (column_at(path), dtype))
                rdef = self._rule_def("cleanse", rule.type)
                expr = rdef.build(expr, cur, **rule.kwargs())
                out_type = rdef.result_type or cur
                if out_type != dtype and cur == dtype:
                    self.notes.append(
                        f"stage {stage.name!r}: {rule.type} turns {'.'.join(path)} "
                        f"from {dtype.simpleString()} into {out_type.simpleString()}"
                    )
                chains[key] = (expr, out_type)
            except (SpecError, RuleTypeError) as e:
                problems.extend(getattr(e, "problems", [str(e)]))
        out: dict[str, Column] = {}
        for path, (expr, out_type) in chains.items():
            types[path] = out_type
            if len(path) == 1:
                out[path[0]] = expr
                continue
            if any("." in p for p in path[1:]):
                problems.append(f"cannot cleanse {'.'.join(path)}: field names with dots")
                continue
            top = out.get(path[0], F.col(quote(path[0])))
            out[path[0]] = top.withField(".".join(path[1:]), expr)
        return out

    # -- outputs ---------------------------------------------------------
    @property
    def rule_ids(self) -> list[str]:
        return [r.id for r in self.rules]

    @property
    def staged(self) -> DataFrame:
        """Input columns (cleansed) plus hidden columns: one boolean per rule, and
        the hit of each rule that joins (``plans.attach``)."""
        return self._staged

    def _outputs(self) -> list[Column]:
        return [F.col(quote(c)) for c in self.input_columns if c != self.results_col]

    def results_map(self) -> Column:
        """Rule id to PASS/FAIL, in rule order; an incoming map comes first,
        without the ids this pipeline checks again (see ``on_recheck``)."""
        if self.map_form == "entries":
            pairs: list[Column] = []
            for r in self.rules:
                pairs += [F.lit(r.id), r.status]
            new = F.create_map(*pairs)
        else:
            keys = F.array(*[F.lit(r.id) for r in self.rules])
            flags = F.array(*[F.col(r.flag) for r in self.rules])
            new = F.map_from_arrays(keys, F.transform(flags, status_of))
        if not self.incoming:
            return new
        prev = F.coalesce(F.col(quote(self.results_col)), F.create_map().cast("map<string,string>"))
        if not self.rules:
            return prev
        ids = self.rule_ids
        return append_results(prev, new, ids if self.on_recheck == "replace" else [])

    def _annotated_cols(self) -> list[Column]:
        if not self.rules and not self.incoming:
            return self._outputs()
        cols = [self.results_map().alias(c) if c == self.results_col else F.col(quote(c)) for c in self.input_columns]
        if not self.incoming:
            cols.append(self.results_map().alias(self.results_col))
        return cols

    def annotated(self) -> DataFrame:
        """The reference's output: input columns, cleansed, then ``_dq_results``
        (kept in place if the input had one; absent if nothing was checked)."""
        return self._staged.select(*self._annotated_cols())

    def verdicts(self, prefix: str = "") -> DataFrame:
        """Input columns, cleansed, then one PASS/FAIL column per rule (no map)."""
        return self.flat(None, prefix)

    def flat(self, keys: Iterable[str] | None = None, prefix: str = "") -> DataFrame:
        """``keys`` then one PASS/FAIL column per rule, named ``prefix + id``."""
        key_cols = [c for c in self.input_columns if c != self.results_col] if keys is None else list(keys)
        names = [prefix + r.id for r in self.rules]
        clash = set(names) & set(key_cols)
        if clash:
            raise SpecError([f"rule ids clash with columns {sorted(clash)}; pass a prefix"])
        return self._staged.select(*[F.col(quote(k)) for k in key_cols], *[r.status.alias(n) for r, n in zip(self.rules, names)])

    def exploded(self, keys: Iterable[str] = ()) -> DataFrame:
        """One row per (row, rule of this pipeline): ``keys, rule_id, status``.

        Like ``flat`` and ``summary`` it leaves verdicts of an incoming map out;
        ``report.exploded(run.annotated())`` lists those too."""
        keys = [F.col(quote(k)) for k in keys]
        if not self.rules:
            none = F.lit(None).cast("string")
            return self._staged.select(*keys, none.alias("rule_id"), none.alias("status")).where(F.lit(False))
        entries = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), r.status.alias("status")) for r in self.rules])
        return self._staged.select(*keys, F.inline(entries))

    def summary(self) -> DataFrame:
        """One row per rule of this pipeline: ``rule_id, n_pass, n_fail,
        n_rows, pass_rate``.  One global aggregate of conditional counts:
        each task ships one partial row, so the shuffle is tiny at any scale.
        The counts are then unpivoted with ``stack``."""
        if not self.rules:
            none = F.lit(None)
            n = F.count(F.lit(1))
            return self._staged.agg(n.alias("n")).select(
                none.cast("string").alias("rule_id"), F.col("n").alias("n_pass"), F.col("n").alias("n_fail"),
                F.col("n").alias("n_rows"), none.cast("double").alias("pass_rate"),
            ).where(F.lit(False))
        # built as SQL text: two calls into the JVM instead of ~10 per rule
        counts = [f"count_if({quote(r.flag)}) AS p{i}" for i, r in enumerate(self.rules)]
        one = self._staged.selectExpr(*counts, "count(1) AS n")
        if all("'" not in r.id for r in self.rules):
            pairs = ", ".join(f"r'{r.id}', p{i}" for i, r in enumerate(self.rules))
            per_rule = one.selectExpr(f"stack({len(self.rules)}, {pairs}) AS (rule_id, n_pass)", "n")
        else:
            entries = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), F.col(f"p{i}").alias("n_pass"))
                                for i, r in enumerate(self.rules)])
            per_rule = one.select(F.inline(entries), F.col("n"))
        return per_rule.selectExpr(
            "rule_id", "n_pass", "n - n_pass AS n_fail", "n AS n_rows", "try_divide(n_pass, n) AS pass_rate"
        )

    def rollup(self, columns: Sequence[str], sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """Verdict counts per rule at every level of ``columns``: ``columns, level,
        rule_id, n_pass, n_fail, n_rows, pass_rate``.

        The levels are those of a rollup (all columns, all but the last, ...,
        none) or the given ``sets``.  The rows are counted once, at the finest level;
        only those partial counts are expanded to the other levels.  ``level`` is
        the grouping id (bit 1 where a column is summed over), which tells a total
        from a NULL in the data.  An empty table has no row, not even a total.
        """
        columns = list(columns)
        if not columns:
            raise SpecError(["rollup needs columns"])
        unknown = [c for s in sets or [] for c in s if c not in columns]
        if unknown:
            raise SpecError([f"rollup sets name columns that are not rolled up: {unknown}"])
        clash = sorted(set(columns) & {"level", "rule_id", "n_pass", "n_fail", "n_rows", "pass_rate"})
        if clash:
            raise SpecError([f"rollup columns named like a result column: {clash}"])
        keys = [f"__k{i}" for i in range(len(columns))]
        passed = [f"__p{i}" for i in range(len(self.rules))]
        counts = [F.count_if(F.col(r.flag)).alias(p) for p, r in zip(passed, self.rules)]
        finest = self._staged.groupBy(*[F.col(quote(c)).alias(k) for c, k in zip(columns, keys)]).agg(*counts, F.count(F.lit(1)).alias("__n"))
        levels = [keys[:i] for i in range(len(keys), -1, -1)] if sets is None else [[keys[columns.index(c)] for c in s] for s in sets]
        sums = [F.sum(p).alias(p) for p in passed]
        per = finest.groupingSets([[F.col(k) for k in s] for s in levels], *[F.col(k) for k in keys]).agg(
            F.grouping_id().alias("level"), *sums, F.sum("__n").alias("__n")).where("__n is not null")
        entries = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), F.col(p).alias("n_pass")) for p, r in zip(passed, self.rules)])
        if not self.rules:
            entries = entries.cast("array<struct<rule_id:string,n_pass:bigint>>")
        rows = per.select(*keys, "level", F.inline(entries), F.col("__n").alias("n_rows"))
        return rows.select(*[F.col(k).alias(c) for k, c in zip(keys, columns)], "level", "rule_id", "n_pass",
                           (F.col("n_rows") - F.col("n_pass")).alias("n_fail"), "n_rows", F.expr("try_divide(n_pass, n_rows)").alias("pass_rate"))

    def worst(self, k: int, keys: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
        """The first ``k`` failing rows of every rule: ``rule_id, rank, keys``.

        First in ``by`` (names or sort expressions), then in ``keys``, which should
        tell rows apart: then the result is the same on every run.  Each task keeps
        at most ``k`` rows a rule before the one exchange, so a rule that a third of
        all rows fail costs no more than another.
        """
        if not self.rules or k < 1:
            names = ", ".join(quote(c) for c in keys)
            return self._staged.where(F.lit(False)).selectExpr("cast(null as string) AS rule_id", "cast(null as int) AS rank", *([names] if names else []))
        ids = F.filter(F.array(*[F.when(~F.col(r.flag), F.lit(r.id)) for r in self.rules]), lambda x: x.isNotNull())
        order = [c if isinstance(c, Column) else F.col(quote(c)) for c in (*by, *keys)]
        named = {f"__o{i}": c for i, c in enumerate(order) if not isinstance(([*by, *keys])[i], Column)}
        sort = [F.col(f"__o{i}") if f"__o{i}" in named else c for i, c in enumerate(order)]
        failing = self._staged.select("*", *[c.alias(n) for n, c in named.items()], F.explode(ids).alias("rule_id"))
        place = Window.partitionBy("rule_id").orderBy(*sort)
        ranked = failing.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        return ranked.select("rule_id", "rank", *[F.col(quote(c)) for c in keys])

    def positions(self, rule_id: str, keys: Iterable[str]) -> DataFrame:
        """``keys, positions``: of every row that fails the ``check_each`` rule, the
        places of its failing elements, from 0 (NULL where the array is NULL)."""
        if rule_id not in self._places:
            raise SpecError([f"no check_each rule {rule_id!r} in this pipeline"])
        flag = next(r.flag for r in self.rules if r.id == rule_id)
        return self._staged.where(~F.col(flag)).select(*[F.col(quote(k)) for k in keys], F.col(self._places[rule_id]).alias("positions"))

    def failed_count(self) -> Column:
        """Number of rules this row failed (0 for a clean row)."""
        if not self.rules:
            return F.lit(0)
        return reduce(add, [F.when(F.col(r.flag), 0).otherwise(1) for r in self.rules])

    def with_failed_count(self, name: str = "_dq_failed") -> DataFrame:
        """``annotated()`` plus the per-row count of failed rules."""
        return self._staged.select(*self._annotated_cols(), self.failed_count().alias(name))

    def split(self, name: str = "_dq_failed") -> tuple[DataFrame, DataFrame]:
        """(clean rows, quarantined rows); no row is lost.  Each side is a
        separate scan; to write both in one pass use ``sources.write_split``."""
        tagged = self.with_failed_count(name)
        return tagged.where(F.col(name) == 0), tagged.where(F.col(name) > 0)

    def observed(self, name: str = "dq") -> tuple[DataFrame, Observation]:
        """``annotated()`` that also counts passes per rule while it is written
        (``Observation.get`` after the action): no second pass for totals."""
        obs = Observation(name)
        aggs = [F.count_if(F.col(r.flag)).alias(r.id) for r in self.rules]
        watched = self._staged.observe(obs, F.count(F.lit(1)).alias("_rows"), *aggs)
        cc = copy.copy(self)
        cc._staged = watched
        return cc.annotated(), obs
