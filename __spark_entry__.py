"""

Every query reads the driver's parquet tables (or a view Spark derives from
them row by row) and runs over whole tables and whole texts.  The
customer-shaped queries use the dirty view of ``rowlint.sources.dirty``
because the driver tables hold no NULLs or padded text; the lineitem,
events, documents and pages queries apply the same operators to the large
tables.  Each oracle is plain SQL for DuckDB with the same column names.

``pipeline_chained``; here they are ``suite_simple``, ``suite_complex`` and
``suite_chained``.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:  # importable when loaded by file path
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlint import DEFAULT_REGISTRY, Param, Pipeline, SpecWarning, derive_rules, reconcile, register_check, report
from rowlint.operators import merge_states, outlier_bounds, outlier_rules, profile_columns, profile_state, read_states
from rowlint.sources import dirty_customers, read_csv, shared_folder, write_csv, write_reports, write_split
from rowlint.sources.dirty import DIRTY_CUSTOMERS_SQL
from rowlint.specs import metadata_frame, spec_path
from rowlint.streaming import matched_within, quality_by_window, unique_within

# the training-data operators are optional: the rest works where their files are
# not there; if they are, their errors are raised
_llm = _pipeline = None
if os.path.exists(os.path.join(_HERE, "rowlint", "llm", "queries.py")):
    from rowlint.llm import queries as _llm

    if os.path.exists(os.path.join(_HERE, "corpus_pipeline.py")):
        import corpus_pipeline as _pipeline

SF_SMOKE = "/root/testdata/sf0.001"

# The mail and date patterns of the bundled specs.
MIXED_MAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
LOWER_MAIL = r"^[a-z0-9_.+-]+@[a-z0-9-]+\.[a-z0-9-.]+$"
DATE_YMD = r"^\d{4}-\d{2}-\d{2}$"
COUNTRIES = ["usa", "uk", "ca", "au", "de"]
# Patterns of the large-table suites (ours): a mail address anywhere in a
# text, a JSON integer field, an https URL.  For a find, one local-part
# character before '@' decides the same rows as a run of them, without the
# backtracking (2x faster on whole texts).
MAIL_IN_TEXT = r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z]{2,}"
MAIL_IN_LOWER_TEXT = r"[a-z0-9._%+-]@[a-z0-9-]+\.[a-z]{2,}"
JSON_INT_FIELD = '"k": [0-9]+'
HTTPS_URL = r"^https://"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_customers(_t(spark, sf_dir, "customer"))


def _one(stage_type: str, rules: list[dict], name: str = "checks") -> Pipeline:
    return Pipeline({"stages": [{"name": name, "type": stage_type, "rules": rules}]})


def _check(rule: dict, keys: list[str]):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _one("dq", [rule]).compile(_dirty(spark, sf_dir)).flat(keys)

    return q


def _clean(rule_type: str, column: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _one("cleanse", [{"type": rule_type, "column": column}], "clean").run(_dirty(spark, sf_dir)).select("id", column)

    return q


SIMPLE = Pipeline(spec_path("email_standardize"))
COMPLEX = Pipeline(spec_path("customers_complex"))


def suite_complex(spark, sf_dir):
    return COMPLEX.compile(_dirty(spark, sf_dir)).verdicts()


def results_exploded(spark, sf_dir):
    return COMPLEX.compile(_dirty(spark, sf_dir)).exploded(["id"])


def dq_summary(spark, sf_dir):
    return COMPLEX.compile(_dirty(spark, sf_dir)).summary()


def summary_from_map(spark, sf_dir):
    # the same summary computed from a bare annotated table (explode + group)
    return report.summary(COMPLEX.run(_dirty(spark, sf_dir)))


def suite_simple(spark, sf_dir):
    return SIMPLE.compile(_dirty(spark, sf_dir)).flat(["id", "email"])


def results_flat(spark, sf_dir):
    # the demos' flattened projection, read back out of the result map
    return report.flat(SIMPLE.run(_dirty(spark, sf_dir)), ["id", "name"], ["rule_1", "rule_2", "rule_3"])


REVERIFY = Pipeline({"stages": [
    {"name": "before", "type": "dq", "rules": [{"id": "before", "type": "check_regex", "column": "email", "pattern": LOWER_MAIL}]},
    {"name": "standardize", "type": "cleanse", "rules": [{"type": "clean_trim", "column": "email"}, {"type": "clean_lowercase", "column": "email"}]},
    {"name": "after", "type": "dq", "rules": [{"id": "after", "type": "check_regex", "column": "email", "pattern": LOWER_MAIL}]},
]})


def reverify(spark, sf_dir):
    return REVERIFY.compile(_dirty(spark, sf_dir)).flat(["id", "email"])


COMPOSE = _one("cleanse", [
    {"type": "clean_trim", "column": "email"},
    {"type": "clean_trim", "column": "country"},
    {"type": "clean_lowercase", "column": "email"},
    {"type": "clean_lowercase", "column": "country"},
], "standardize")


def cleanse_compose(spark, sf_dir):
    return COMPOSE.run(_dirty(spark, sf_dir)).select("id", "email", "country")


LATE = _one("dq", [{"id": "late", "type": "check_not_null", "column": "country"}], "late")


def suite_chained(spark, sf_dir):
    first = SIMPLE.run(_dirty(spark, sf_dir))
    second = LATE.run(first)  # appends to the incoming map
    return report.flat(second, ["id"], ["rule_1", "rule_2", "rule_3", "late"])


def unknown_rule_skipped(spark, sf_dir):
    # an unknown stage type and an unknown rule type: both skipped
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SpecWarning)
        p = Pipeline({"stages": [
            {"name": "enrich", "type": "enrich", "rules": [{"type": "clean_lowercase", "column": "email"}]},
            {"name": "checks", "type": "dq", "rules": [
                {"id": "dq_email_not_null", "type": "check_not_null", "column": "email"},
                {"id": "dq_email_domain", "type": "check_email_domain", "column": "email"},
            ]},
        ]})
    return p.compile(_dirty(spark, sf_dir)).exploded(["id"])


CUSTOM = DEFAULT_REGISTRY.copy()


@register_check("check_starts_with", params=[Param("prefix", "str")], registry=CUSTOM)
def _starts_with(c, dtype, prefix):
    return c.startswith(prefix)


def custom_rule(spark, sf_dir):
    p = Pipeline({"stages": [{"name": "custom", "type": "dq", "rules": [
        {"id": "dq_name_prefix", "type": "check_starts_with", "column": "name", "prefix": "Customer#"}]}]},
        registry=CUSTOM)
    return p.compile(_dirty(spark, sf_dir)).flat(["id", "name"])


def suite_applied(spark, sf_dir):
    suite = Pipeline.from_rule_table(derive_rules(metadata_frame(spark)))
    return suite.compile(_dirty(spark, sf_dir)).flat(["id"])


# -- the same operators over the large tables ----------------------------
LINEITEM = Pipeline({"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "li_qty_range", "type": "check_range", "column": "l_quantity", "min": 10, "max": 40},
        {"id": "li_discount_max", "type": "check_max", "column": "l_discount", "value": 0.05},
        {"id": "li_tax_min", "type": "check_min", "column": "l_tax", "value": 0.02},
        {"id": "li_flag_set", "type": "check_in_set", "column": "l_returnflag", "values": ["A", "R"]},
        {"id": "li_status_fmt", "type": "check_regex", "column": "l_linestatus", "pattern": "^[O]$"},
        {"id": "li_ship_nn", "type": "check_not_null", "column": "l_shipdate"},
    ]},
    {"name": "standardize", "type": "cleanse", "rules": [
        {"type": "clean_lowercase", "column": "l_returnflag"},
        {"type": "clean_lowercase", "column": "l_linestatus"},
    ]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "li_flag_lower", "type": "check_in_set", "column": "l_returnflag", "values": ["a", "n", "r"]},
        {"id": "li_price_min", "type": "check_min", "column": "l_extendedprice", "value": 10000},
        {"id": "li_orderkey_len", "type": "check_length", "column": "l_orderkey", "min_len": 1, "max_len": 4},
    ]},
]})

LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]


def lineitem_checks(spark, sf_dir):
    return LINEITEM.compile(_t(spark, sf_dir, "lineitem")).flat(LINEITEM_KEYS)


def _numeric_min_suite(n: int) -> Pipeline:
    # n numeric >= checks over lineitem's measures, thresholds spread out
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    scale = {"l_quantity": 50.0, "l_extendedprice": 100000.0, "l_discount": 0.1, "l_tax": 0.08}
    rules = []
    for i in range(n):
        c = cols[i % len(cols)]
        rules.append({"id": f"min_{i}", "type": "check_min", "column": c, "value": scale[c] * (i + 1) / (n + 1)})
    return _one("dq", rules)


SUMMARY12 = _numeric_min_suite(12)


def lineitem_summary(spark, sf_dir):
    return SUMMARY12.compile(_t(spark, sf_dir, "lineitem")).summary()


EVENTS = Pipeline({"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "ev_type_set", "type": "check_in_set", "column": "event_type", "values": ["view", "click", "purchase"]},
        {"id": "ev_value_range", "type": "check_range", "column": "value", "min": 1, "max": 400},
        {"id": "ev_props_fmt", "type": "check_regex", "column": "props", "pattern": JSON_INT_FIELD},
    ]},
    {"name": "standardize", "type": "cleanse", "rules": [{"type": "clean_uppercase", "column": "event_type"}]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "ev_type_len", "type": "check_length", "column": "event_type", "min_len": 4, "max_len": 5},
        {"id": "ev_user_min", "type": "check_min", "column": "user_id", "value": 10},
    ]},
]})


def events_checks(spark, sf_dir):
    return EVENTS.compile(_t(spark, sf_dir, "events")).flat(["event_id", "event_type"])


def events_quality_by_day(spark, sf_dir):
    return quality_by_window(EVENTS.compile(_t(spark, sf_dir, "events")), "ts", "1 day")


DOCUMENTS = Pipeline({"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "doc_len_raw", "type": "check_length", "column": "text", "min_len": 50, "max_len": 20000},
        {"id": "doc_has_mail", "type": "check_regex", "column": "text", "pattern": MAIL_IN_TEXT},
        {"id": "doc_lang_set", "type": "check_in_set", "column": "lang", "values": ["en", "de", "fr"]},
        {"id": "doc_nchars_min", "type": "check_min", "column": "n_chars", "value": 100},
    ]},
    {"name": "standardize", "type": "cleanse", "rules": [
        {"type": "clean_trim", "column": "text"},
        {"type": "clean_lowercase", "column": "text"},
    ]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "doc_len_clean", "type": "check_length", "column": "text", "min_len": 50, "max_len": 20000},
        {"id": "doc_has_mail_lower", "type": "check_regex", "column": "text", "pattern": MAIL_IN_LOWER_TEXT},
    ]},
]})


def documents_checks(spark, sf_dir):
    return DOCUMENTS.compile(_t(spark, sf_dir, "documents")).flat(["doc_id", "n_chars"])


PAGES = Pipeline({"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "url_https", "type": "check_regex", "column": "url", "pattern": HTTPS_URL},
        {"id": "url_len", "type": "check_length", "column": "url", "max_len": 45},
        {"id": "html_len", "type": "check_length", "column": "html", "min_len": 1000},
    ]},
    {"name": "standardize", "type": "cleanse", "rules": [{"type": "clean_uppercase", "column": "url"}]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "url_upper_http", "type": "check_regex", "column": "url", "pattern": "^HTTP://"},
    ]},
]})


def pages_checks(spark, sf_dir):
    return PAGES.compile(_t(spark, sf_dir, "pages")).flat(["page_id", "url"])


ORDERS = Pipeline({"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "ord_status_set", "type": "check_in_set", "column": "o_orderstatus", "values": ["F", "O"]},
        {"id": "ord_priority_fmt", "type": "check_regex", "column": "o_orderpriority", "pattern": "^[1-3]-"},
        {"id": "ord_price_range", "type": "check_range", "column": "o_totalprice", "min": 5000, "max": 400000},
        {"id": "ord_cust_min", "type": "check_min", "column": "o_custkey", "value": 100},
    ]},
    {"name": "standardize", "type": "cleanse", "rules": [{"type": "clean_lowercase", "column": "o_orderpriority"}]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "ord_priority_len", "type": "check_length", "column": "o_orderpriority", "min_len": 5, "max_len": 8},
        {"id": "ord_priority_lower", "type": "check_regex", "column": "o_orderpriority", "pattern": "^[0-9]-[a-z ]+"},
    ]},
]})


def orders_checks(spark, sf_dir):
    return ORDERS.compile(_t(spark, sf_dir, "orders")).flat(["o_orderkey", "o_orderpriority"])


CONVERSATIONS = Pipeline({"stages": [
    {"name": "ingest", "type": "dq", "rules": [
        {"id": "conv_role_set", "type": "check_in_set", "column": "role", "values": ["user", "assistant"]},
        {"id": "conv_text_len", "type": "check_length", "column": "text", "min_len": 30, "max_len": 1000},
        {"id": "conv_text_sentence", "type": "check_regex", "column": "text", "pattern": "[.!]"},
        {"id": "conv_turn_max", "type": "check_max", "column": "turn", "value": 6},
    ]},
    {"name": "standardize", "type": "cleanse", "rules": [
        {"type": "clean_trim", "column": "text"}, {"type": "clean_uppercase", "column": "role"}]},
    {"name": "verify", "type": "dq", "rules": [
        {"id": "conv_role_upper", "type": "check_in_set", "column": "role", "values": ["USER", "ASSISTANT", "SYSTEM"]},
        {"id": "conv_text_len_clean", "type": "check_length", "column": "text", "min_len": 30, "max_len": 1000},
    ]},
]})


def conversations_checks(spark, sf_dir):
    return CONVERSATIONS.compile(_t(spark, sf_dir, "conversations")).flat(["conv_id", "turn", "role"])


REFERENCES = Pipeline({"stages": [
    {"name": "references", "type": "dq", "rules": [
        {"id": "li_part_small", "type": "check_in_table", "column": "l_partkey", "table": "small_parts", "key": "p_partkey"},
        {"id": "li_supp_solvent", "type": "check_in_table", "column": "l_suppkey", "table": "solvent_suppliers", "key": "s_suppkey"},
        {"id": "li_order_known", "type": "check_in_table", "column": "l_orderkey", "table": "orders", "key": "o_orderkey"},
    ]},
]})


def lineitem_references(spark, sf_dir):
    # referential checks against tables Spark derives from the driver tables
    tables = {
        "small_parts": _t(spark, sf_dir, "part").where(F.col("p_size") <= 25),
        "solvent_suppliers": _t(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0),
        "orders": _t(spark, sf_dir, "orders"),
    }
    return REFERENCES.compile(_t(spark, sf_dir, "lineitem"), tables=tables).flat(["l_orderkey", "l_linenumber"])


GOOD_CUSTOMERS = _one("dq", [
    {"id": "ord_cust_good", "type": "check_in_table", "column": "o_custkey", "table": "good_customers", "key": "c_custkey"}])


def orders_customer_ref(spark, sf_dir):
    good = _t(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return GOOD_CUSTOMERS.compile(_t(spark, sf_dir, "orders"), tables={"good_customers": good}).flat(["o_orderkey", "o_custkey"])


# -- sets of numbers and dates, with members that do not fit the column ----
with warnings.catch_warnings():
    warnings.simplefilter("ignore", SpecWarning)
    SETS = _one("dq", [
        {"id": "int_set", "type": "check_in_set", "column": "l_linenumber", "values": [1, 2.0, 1.5, True, "3", "x", 1 << 40]},
        {"id": "double_set", "type": "check_in_set", "column": "l_quantity", "values": [10, 20.0, "30", 40.5, False]},
        {"id": "decimal_set", "type": "check_in_set", "column": "tax", "values": [0.01, 0.029, 0.06, "0.08", 1e9]},
        {"id": "date_set", "type": "check_in_set", "column": "ship", "values": ["1995", "1995-01", "1995-03-15", "1996-06-30", "never"]},
    ])


def lineitem_sets(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumns({"tax": F.col("l_tax").cast("decimal(10,2)"), "ship": F.col("l_shipdate").cast("date")})
    return SETS.compile(li).flat(["l_orderkey", "l_linenumber"])


def events_quality_untimed(spark, sf_dir):
    # every seventh event without a time: counted under a NULL window
    ev = _t(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    return quality_by_window(EVENTS.compile(ev), "ts", "1 day")


def documents_profile(spark, sf_dir):
    # a rule suite derived from the columns of the whole table
    meta = profile_columns(_t(spark, sf_dir, "documents"), patterns={"lang": "^[a-z]{2}$"}, enums={"lang": ["en", "de", "fr", "es"]})
    return derive_rules(meta).withColumn("values", F.array_join("values", ","))


# -- sources and sinks ---------------------------------------------------
def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/rowlint-{uuid.uuid4().hex}/{name}"


def csv_scan(spark, sf_dir):
    # the dirty view as CSV files, read back as text and checked
    path = _scratch(spark, "customers")
    write_csv(_dirty(spark, sf_dir), path)
    return COMPLEX.compile(read_csv(spark, path)).flat(["id", "name", "email", "age", "country", "signup_date"])


def report_tables(spark, sf_dir):
    # the report sink: the summary and the flat verdicts, reread and put side by side
    path = _scratch(spark, "reports")
    run = COMPLEX.compile(_dirty(spark, sf_dir))
    write_reports(run, path, ["id"])
    flat = spark.read.parquet(f"{path}/flat")
    failed = flat.select(F.explode(F.array(*[F.struct(F.lit(i).alias("rule_id"), F.col(i).alias("status")) for i in run.rule_ids])).alias("r"))
    counted = failed.groupBy("r.rule_id").agg(F.count_if(F.col("r.status") == "FAIL").alias("n_fail_flat"))
    return spark.read.parquet(f"{path}/summary").join(counted, "rule_id")


def split_counts(spark, sf_dir):
    # clean and quarantined rows written in one pass, reread: none is lost
    path = _scratch(spark, "split")
    write_split(ORDERS.compile(_t(spark, sf_dir, "orders")), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("_dq_passed").cast("string").alias("passed"), F.col("_dq_failed").alias("n_failed")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys"))


def observed_counts(spark, sf_dir):
    # verdicts counted while the annotated rows are written
    rows, seen = EVENTS.compile(_t(spark, sf_dir, "events")).observed()
    rows.write.parquet(_scratch(spark, "events"))
    got = seen.get
    return spark.createDataFrame([(k, v, got["_rows"]) for k, v in got.items() if k != "_rows"], "rule_id string, n_pass long, n_rows long")


# -- rules that need more than the row -------------------------------------
ORDERS_UNIQUE = _one("dq", [
    {"id": "ord_key_once", "type": "check_unique", "column": "o_orderkey"},
    {"id": "ord_cust_day_once", "type": "check_unique", "column": "o_custkey", "columns": ["o_orderdate"]},
    {"id": "ord_priority_once", "type": "check_unique", "column": "o_orderpriority"},
    {"id": "ord_clerk_once", "type": "check_unique", "column": "big", "columns": ["o_custkey"]},
])


def orders_unique(spark, sf_dir):
    # one key that is unique, one nearly, one hot, and one that is mostly NULL
    orders = _t(spark, sf_dir, "orders").withColumn("big", F.when(F.col("o_totalprice") > 300000, F.col("o_orderstatus")))
    return ORDERS_UNIQUE.compile(orders).flat(["o_orderkey"])


TEXT_UNIQUE = _one("dq", [{"id": "doc_text_once", "type": "check_unique", "column": "text", "digest": True}])


def documents_unique(spark, sf_dir):
    return TEXT_UNIQUE.compile(_t(spark, sf_dir, "documents")).flat(["doc_id"])


# a later version of orders, as SQL that Spark and DuckDB both read: rows gone,
# prices and states changed, dates lost, new keys, and rows written twice
ORDERS_LATER = """WITH v AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority
  FROM {orders} WHERE o_orderkey % 13 <> 3)
SELECT * FROM v UNION ALL SELECT * FROM v WHERE o_orderkey % 19 = 0
UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM v WHERE o_orderkey % 17 = 0"""


def orders_reconcile(spark, sf_dir):
    old = _t(spark, sf_dir, "orders")
    new = spark.sql(ORDERS_LATER.format(orders="{orders}"), orders=old)
    return reconcile(old, new, ["o_orderkey"]).withColumn("changed_columns", F.array_join("changed_columns", ","))


PERIODS = _one("dq", [
    {"id": "li_in_big_week", "type": "check_interval", "column": "l_shipdate", "table": "big_orders", "start": "o_orderdate", "end": "until", "bin": 864000},
    {"id": "li_in_own_month", "type": "check_interval", "column": "l_shipdate", "table": "own", "start": "o_orderdate", "end": "until", "bin": 864000,
     "on": ["l_orderkey=o_orderkey"], "closed": "left"},
    {"id": "li_price_band", "type": "check_interval", "column": "l_extendedprice", "table": "bands", "start": "low", "end": "high", "bin": 5000},
])


def lineitem_periods(spark, sf_dir):
    # ship dates in the week after any large order, and in the month after their own; prices near a customer's balance
    orders = _t(spark, sf_dir, "orders")
    tables = {
        "big_orders": orders.where("o_totalprice > 480000").withColumn("until", F.expr("o_orderdate + INTERVAL 7 DAYS")),
        "own": orders.withColumn("until", F.expr("o_orderdate + INTERVAL 30 DAYS")),
        "bands": _t(spark, sf_dir, "customer").selectExpr("c_acctbal * 10 AS low", "c_acctbal * 10 + 25 AS high"),
    }
    return PERIODS.compile(_t(spark, sf_dir, "lineitem"), tables=tables).flat(["l_orderkey", "l_linenumber"])


EVENTS_SEQUENCE = _one("dq", [
    {"id": "ev_no_step_back", "type": "check_sequence", "column": "ts", "by": ["user_id"], "order": "event_id", "min_step": 0, "span": 2000},
    {"id": "ev_within_hours", "type": "check_sequence", "column": "ts", "by": ["user_id"], "max_step": 43200, "span": 604800},
    {"id": "ev_id_no_gap", "type": "check_sequence", "column": "event_id", "by": ["all"], "first": 0, "span": 512},
    {"id": "ev_value_rises", "type": "check_sequence", "column": "value", "by": ["event_type"], "order": "event_id", "min_step": 0},
])


def events_sequence(spark, sf_dir):
    # "all" is one key that holds every row: its stretches are checked in parallel
    return EVENTS_SEQUENCE.compile(_t(spark, sf_dir, "events").withColumn("all", F.lit(1))).flat(["event_id"])


TURNS_SEQUENCE = _one("dq", [{"id": "turn_follows", "type": "check_sequence", "column": "turn", "by": ["conv_id"], "first": 0, "span": 64}])


def conversations_sequence(spark, sf_dir):
    # user turns only: their numbers have gaps, and some conversations open with the system
    turns = _t(spark, sf_dir, "conversations").where("role <> 'system'")
    return TURNS_SEQUENCE.compile(turns).flat(["conv_id", "turn"])


def lineitem_rollup(spark, sf_dir):
    return LINEITEM.compile(_t(spark, sf_dir, "lineitem")).rollup(["l_returnflag", "l_linestatus"])


def lineitem_worst(spark, sf_dir):
    return LINEITEM.compile(_t(spark, sf_dir, "lineitem")).worst(25, ["l_orderkey", "l_linenumber"], by=[F.desc("l_extendedprice")])


# -- JSON text, elements, quantiles, mergeable profiles ------------------------
# props as they are, and with every kind of fault, as SQL that Spark and DuckDB both read
PROPS = """CASE event_id % 9 WHEN 0 THEN 'oops' WHEN 1 THEN '{"k": "x"}' WHEN 2 THEN NULL WHEN 3 THEN '{"k": 7, "user": {"name": "ann", "age": 30}}'
  WHEN 4 THEN '{"user": {"name": "bo"}}' WHEN 5 THEN '' ELSE props END"""
PROPS_JSON = _one("dq", [
    {"id": "ev_props_shape", "type": "check_json", "column": "props", "schema": "k int, user struct<name string, age int>"},
    {"id": "ev_k_range", "type": "check_range", "column": "props->k", "min": 20, "max": 80},
    {"id": "ev_user_named", "type": "check_length", "column": "props->user.name", "min_len": 3},
])


def events_json(spark, sf_dir):
    return PROPS_JSON.compile(_t(spark, sf_dir, "events").withColumn("props", F.expr(PROPS))).flat(["event_id"])


ELEMENTS = _one("dq", [
    {"id": "emb_small", "type": "check_each", "column": "embedding", "rule": "check_range", "args": {"min": -0.25, "max": 0.25}},
    {"id": "emb_there", "type": "check_each", "column": "embedding", "rule": "check_not_null"},
])


def embeddings_each(spark, sf_dir):
    # the places of the components that are too large
    run = ELEMENTS.compile(_t(spark, sf_dir, "embeddings"))
    places = run.positions("emb_small", ["vec_id"]).withColumn("places", F.array_join(F.col("positions").cast("array<string>"), ","))
    return run.flat(["vec_id"]).join(places.select("vec_id", "places"), "vec_id", "left")


def lineitem_outliers(spark, sf_dir):
    # range rules from exact quartiles, then run over the same table
    li = _t(spark, sf_dir, "lineitem")
    bounds = outlier_bounds(li, ["l_extendedprice", "l_quantity", "l_discount"], fence=0.5)
    run = _one("dq", outlier_rules(bounds)).compile(li)
    return run.summary().join(bounds, F.concat(F.lit("outlier_"), "column") == F.col("rule_id")).select("rule_id", "min", "max", "n_pass", "n_fail")


def events_profile(spark, sf_dir):
    # states by day, written, reread and merged to months; the sketches' error against exact counts
    events = _t(spark, sf_dir, "events").withColumns({"day": F.to_date("ts"), "value": F.when(F.col("event_id") % 5 != 0, F.col("value"))})
    path = _scratch(spark, "states")
    profile_state(events, ["user_id", "event_type", "value"], by=["day"]).write.parquet(path)
    states = spark.read.parquet(path).withColumn("month", F.date_format("day", "yyyy-MM"))
    merged = read_states(merge_states(states, by=["month"], order={"user_id": "long", "value": "double"}))
    exact = events.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(*[F.count_distinct(c).alias(c) for c in ("user_id", "event_type", "value")])
    exact = exact.select("month", F.expr("stack(3, 'user_id', user_id, 'event_type', event_type, 'value', value) AS (column, n_exact)"))
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.greatest(F.lit(1.0), F.col("n_exact") * 0.04)
    return merged.join(exact, ["month", "column"]).select("month", "column", "n_rows", "n_nulls", F.col("min").try_cast("double").alias("lo"),
                                                          F.col("max").try_cast("double").alias("hi"), "n_exact", close.alias("close")).where("column <> 'event_type'")


# -- events judged by other events ------------------------------------------
def _matched(events):
    return matched_within(events, ["user_id"], "ts", F.col("event_type") == "view", F.col("event_type") == "purchase", "36 hours",
                          watermark="1 hour" if events.isStreaming else None).select("event_id", "user_id", "status")


def events_matched(spark, sf_dir):
    # is a view followed by a purchase of the same user within 36 hours?
    return _matched(_t(spark, sf_dir, "events"))


def events_matched_stream(spark, sf_dir):
    # the same from a stream; two events of no user, a year on, let the watermark pass all others
    events = _t(spark, sf_dir, "events")
    top = _scratch(spark, "events")
    events.write.parquet(f"{top}/in")
    late = events.agg(F.max("event_id").alias("e"), F.max("ts").alias("t")).selectExpr(
        "e + 1 AS event_id", "t + INTERVAL 365 DAYS AS ts", "-1L AS user_id", "explode(array('purchase', 'view')) AS event_type", "0D AS value", "'' AS props")
    late.select(events.columns).write.mode("append").parquet(f"{top}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{top}/in")
    _matched(stream).writeStream.format("parquet").option("path", f"{top}/out").option("checkpointLocation", f"{top}/state").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{top}/out").where("user_id >= 0")


def _repeats(events):
    return unique_within(events, ["user_id", "event_type"], "ts", "2 hours", order=["event_id"],
                         watermark="1 hour" if events.isStreaming else None).select("event_id", "status")


def events_repeats(spark, sf_dir):
    # the same kind of event of a user again within two hours
    return _repeats(_t(spark, sf_dir, "events"))


def events_repeats_stream(spark, sf_dir):
    # the same from a stream, run twice with one checkpoint: no event is counted again
    events = _t(spark, sf_dir, "events")
    top = _scratch(spark, "events")
    events.write.parquet(f"{top}/in")
    for _ in range(2):
        stream = spark.readStream.schema(events.schema).parquet(f"{top}/in")
        _repeats(stream).writeStream.format("parquet").option("path", f"{top}/out").option("checkpointLocation", f"{top}/state").trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{top}/out")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the seven-rule customer suite over the dirty view, summarised."""
    return dq_summary(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "check_not_null": _check({"id": "dq_email_not_null", "type": "check_not_null", "column": "email"}, ["id", "email"]),
        "check_regex": _check({"id": "dq_email_format", "type": "check_regex", "column": "email", "pattern": MIXED_MAIL}, ["id", "email"]),
        "check_min": _check({"id": "dq_age_legal", "type": "check_min", "column": "age", "value": 18}, ["id", "age"]),
        "check_max": _check({"id": "dq_age_max", "type": "check_max", "column": "age", "value": 120}, ["id", "age"]),
        "check_range": _check({"id": "dq_age_range", "type": "check_range", "column": "age", "min": 18, "max": 120}, ["id", "age"]),
        "check_in_set": _check({"id": "dq_country_valid", "type": "check_in_set", "column": "country", "values": COUNTRIES}, ["id", "country"]),
        "check_length": _check({"id": "dq_name_len", "type": "check_length", "column": "name", "min_len": 2, "max_len": 18}, ["id", "name"]),
        "clean_trim": _clean("clean_trim", "name"),
        "clean_lowercase": _clean("clean_lowercase", "email"),
        "clean_uppercase": _clean("clean_uppercase", "country"),
        "suite_complex": suite_complex,
        "results_exploded": results_exploded,
        "dq_summary": dq_summary,
        "summary_from_map": summary_from_map,
        "suite_simple": suite_simple,
        "reverify": reverify,
        "results_flat": results_flat,
        "cleanse_compose": cleanse_compose,
        "suite_chained": suite_chained,
        "unknown_rule_skipped": unknown_rule_skipped,
        "custom_rule": custom_rule,
        "suite_applied": suite_applied,
        "lineitem_checks": lineitem_checks,
        "lineitem_summary": lineitem_summary,
        "events_checks": events_checks,
        "events_quality_by_day": events_quality_by_day,
        "documents_checks": documents_checks,
        "pages_checks": pages_checks,
        "orders_checks": orders_checks,
        "conversations_checks": conversations_checks,
        "lineitem_references": lineitem_references,
        "orders_customer_ref": orders_customer_ref,
        "lineitem_sets": lineitem_sets,
        "events_quality_untimed": events_quality_untimed,
        "documents_profile": documents_profile,
        "csv_scan": csv_scan,
        "report_tables": report_tables,
        "split_counts": split_counts,
        "observed_counts": observed_counts,
        "orders_unique": orders_unique,
        "documents_unique": documents_unique,
        "orders_reconcile": orders_reconcile,
        "lineitem_periods": lineitem_periods,
        "events_sequence": events_sequence,
        "conversations_sequence": conversations_sequence,
        "lineitem_rollup": lineitem_rollup,
        "lineitem_worst": lineitem_worst,
        "events_json": events_json,
        "embeddings_each": embeddings_each,
        "lineitem_outliers": lineitem_outliers,
        "events_profile": events_profile,
        "events_matched": events_matched,
        "events_matched_stream": events_matched_stream,
        "events_repeats": events_repeats,
        "events_repeats_stream": events_repeats_stream,
        **(_llm.QUERIES if _llm else {}),
        **({"pipeline": _pipeline.run} if _pipeline else {}),
    }


# ---------------------------------------------------------------- oracles
def _st(pred: str, name: str) -> str:
    return f"CASE WHEN {pred} THEN 'PASS' ELSE 'FAIL' END AS {name}"


D = f"WITH d AS ({DIRTY_CUSTOMERS_SQL})"

# the complex suite in three CTEs, one per stage
_COMPLEX_CTES = f"""{D},
s1 AS (SELECT *, email IS NOT NULL AS f1, regexp_matches(signup_date, '{DATE_YMD}') AS f2 FROM d),
s2 AS (SELECT id, trim(name, ' ') AS name, lower(trim(email, ' ')) AS email, age, lower(country) AS country,
              signup_date, f1, f2 FROM s1),
s3 AS (SELECT *, try_cast(age AS DOUBLE) >= 18 AS f3, try_cast(age AS DOUBLE) <= 120 AS f4,
              country IN ('usa', 'uk', 'ca', 'au', 'de') AS f5, regexp_matches(email, '{LOWER_MAIL}') AS f6,
              length(name) >= 2 AND length(name) <= 50 AS f7 FROM s2)"""

_COMPLEX_IDS = ["dq_email_not_null", "dq_date_format", "dq_age_legal", "dq_age_max", "dq_country_valid",
                "dq_email_valid", "dq_name_len"]

_COMPLEX_EXPLODED = " UNION ALL ".join(
    f"SELECT id, '{rid}' AS rule_id, CASE WHEN f{i} THEN 'PASS' ELSE 'FAIL' END AS status FROM s3"
    for i, rid in enumerate(_COMPLEX_IDS, start=1)
)

_SUMMARY_OF_E = """SELECT rule_id,
  count(*) FILTER (WHERE status = 'PASS') AS n_pass,
  count(*) FILTER (WHERE status = 'FAIL') AS n_fail,
  count(*) AS n_rows,
  CAST(count(*) FILTER (WHERE status = 'PASS') AS DOUBLE) / count(*) AS pass_rate
FROM e GROUP BY rule_id"""

_SIMPLE_CTE = f"""{D},
s AS (SELECT id, name, lower(trim(email, ' ')) AS email, country,
        email IS NOT NULL AS f1, regexp_matches(email, '{MIXED_MAIL}') AS f2 FROM d),
t AS (SELECT *, regexp_matches(email, '{LOWER_MAIL}') AS f3 FROM s)"""

_LI = """SELECT l_orderkey, l_linenumber, l_extendedprice, lower(l_returnflag) AS l_returnflag, lower(l_linestatus) AS l_linestatus,
  l_quantity BETWEEN 10 AND 40 AS f1, l_discount <= CAST(0.05 AS DOUBLE) AS f2, l_tax >= CAST(0.02 AS DOUBLE) AS f3,
  l_returnflag IN ('A', 'R') AS f4, regexp_matches(l_linestatus, '^[O]$') AS f5, l_shipdate IS NOT NULL AS f6,
  lower(l_returnflag) IN ('a', 'n', 'r') AS f7, l_extendedprice >= 10000 AS f8,
  length(CAST(l_orderkey AS VARCHAR)) >= 1 AND length(CAST(l_orderkey AS VARCHAR)) <= 4 AS f9
FROM lineitem"""

_LI_IDS = ["li_qty_range", "li_discount_max", "li_tax_min", "li_flag_set", "li_status_fmt", "li_ship_nn",
           "li_flag_lower", "li_price_min", "li_orderkey_len"]

_EV = f"""SELECT event_id, ts, upper(event_type) AS event_type,
  event_type IN ('view', 'click', 'purchase') AS f1, value BETWEEN 1 AND 400 AS f2,
  regexp_matches(props, '{JSON_INT_FIELD}') AS f3,
  length(upper(event_type)) >= 4 AND length(upper(event_type)) <= 5 AS f4, user_id >= 10 AS f5
FROM events"""

_EV_IDS = ["ev_type_set", "ev_value_range", "ev_props_fmt", "ev_type_len", "ev_user_min"]


_ORD = """SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority,
  o_orderstatus IN ('F', 'O') AS f1, regexp_matches(o_orderpriority, '^[1-3]-') AS f2,
  o_totalprice BETWEEN 5000 AND 400000 AS f3, o_custkey >= 100 AS f4,
  length(lower(o_orderpriority)) BETWEEN 5 AND 8 AS f5,
  regexp_matches(lower(o_orderpriority), '^[0-9]-[a-z ]+') AS f6 FROM orders"""


def _flags(ids: list[str]) -> str:
    return ", ".join(_st(f"coalesce(f{i}, false)", rid) for i, rid in enumerate(ids, start=1))


def _suite_numeric_min_sql(n: int) -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    scale = {"l_quantity": 50.0, "l_extendedprice": 100000.0, "l_discount": 0.1, "l_tax": 0.08}
    parts = []
    for i in range(n):
        c = cols[i % len(cols)]
        v = scale[c] * (i + 1) / (n + 1)
        parts.append(
            f"SELECT 'min_{i}' AS rule_id, count(*) FILTER (WHERE {c} >= CAST({v!r} AS DOUBLE)) AS n_pass, "
            f"count(*) AS n_rows FROM lineitem"
        )
    return ("SELECT rule_id, n_pass, n_rows - n_pass AS n_fail, n_rows, CAST(n_pass AS DOUBLE) / n_rows AS pass_rate FROM ("
            + " UNION ALL ".join(parts) + ")")


_MATCHED = """SELECT event_id, user_id, CASE WHEN EXISTS (SELECT 1 FROM events t WHERE t.user_id = f.user_id AND t.event_type = 'purchase'
    AND t.ts > f.ts AND t.ts <= f.ts + INTERVAL 36 HOUR) THEN 'PASS' ELSE 'FAIL' END AS status
FROM events f WHERE event_type = 'view'"""
_REPEATS = """SELECT event_id, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) <= 7200000000
    THEN 'FAIL' ELSE 'PASS' END AS status FROM events"""


def oracle_sql() -> dict[str, str]:
    def check(pred: str, rid: str, col: str) -> str:
        return f"{D} SELECT id, {col}, {_st(pred, rid)} FROM d"

    return {
        "check_not_null": check("email IS NOT NULL", "dq_email_not_null", "email"),
        "check_regex": check(f"regexp_matches(email, '{MIXED_MAIL}')", "dq_email_format", "email"),
        "check_min": check("try_cast(age AS DOUBLE) >= 18", "dq_age_legal", "age"),
        "check_max": check("try_cast(age AS DOUBLE) <= 120", "dq_age_max", "age"),
        "check_range": check("try_cast(age AS DOUBLE) BETWEEN 18 AND 120", "dq_age_range", "age"),
        "check_in_set": check("country IN ('usa', 'uk', 'ca', 'au', 'de')", "dq_country_valid", "country"),
        "check_length": check("length(name) >= 2 AND length(name) <= 18", "dq_name_len", "name"),
        "clean_trim": f"{D} SELECT id, trim(name, ' ') AS name FROM d",
        "clean_lowercase": f"{D} SELECT id, lower(email) AS email FROM d",
        "clean_uppercase": f"{D} SELECT id, upper(country) AS country FROM d",
        "suite_complex": f"{_COMPLEX_CTES} SELECT id, name, email, age, country, signup_date, "
        + ", ".join(_st(f"coalesce(f{i}, false)", rid) for i, rid in enumerate(_COMPLEX_IDS, start=1))
        + " FROM s3",
        "results_exploded": f"{_COMPLEX_CTES} {_COMPLEX_EXPLODED}",
        "dq_summary": f"{_COMPLEX_CTES}, e AS ({_COMPLEX_EXPLODED}) {_SUMMARY_OF_E}",
        "summary_from_map": f"{_COMPLEX_CTES}, e AS ({_COMPLEX_EXPLODED}) {_SUMMARY_OF_E}",
        "suite_simple": f"{_SIMPLE_CTE} SELECT id, email, {_flags(['rule_1', 'rule_2', 'rule_3'])} FROM t",
        "reverify": f"""{D} SELECT id, lower(trim(email, ' ')) AS email,
            {_st(f"regexp_matches(email, '{LOWER_MAIL}')", 'before')},
            {_st(f"regexp_matches(lower(trim(email, ' ')), '{LOWER_MAIL}')", 'after')} FROM d""",
        "results_flat": f"{_SIMPLE_CTE} SELECT id, name, {_flags(['rule_1', 'rule_2', 'rule_3'])} FROM t",
        "cleanse_compose": f"{D} SELECT id, lower(trim(email, ' ')) AS email, lower(trim(country, ' ')) AS country FROM d",
        "suite_chained": f"""{_SIMPLE_CTE} SELECT id, {_flags(['rule_1', 'rule_2', 'rule_3'])},
            {_st('country IS NOT NULL', 'late')} FROM t""",
        "unknown_rule_skipped": f"{D} SELECT id, 'dq_email_not_null' AS rule_id, "
        "CASE WHEN email IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS status FROM d",
        "custom_rule": f"{D} SELECT id, name, " + _st("starts_with(name, 'Customer#')", "dq_name_prefix") + " FROM d",
        "suite_applied": f"""{D},
            s1 AS (SELECT *, id IS NOT NULL AS f1, regexp_matches(email, '{LOWER_MAIL}') AS f2,
                          regexp_matches(signup_date, '{DATE_YMD}') AS f3 FROM d),
            s2 AS (SELECT id, trim(name, ' ') AS name, lower(trim(email, ' ')) AS email, age,
                          lower(trim(country, ' ')) AS country, f1, f2, f3 FROM s1),
            s3 AS (SELECT *, length(name) BETWEEN 0 AND 50 AS f4, length(email) BETWEEN 0 AND 100 AS f5,
                          try_cast(age AS DOUBLE) >= 18 AS f6, try_cast(age AS DOUBLE) <= 120 AS f7,
                          country IN ('usa', 'uk', 'ca', 'au', 'de') AS f8, length(country) BETWEEN 0 AND 2 AS f9 FROM s2)
            SELECT id, {_flags(['dq_id_not_null', 'dq_email_regex', 'dq_signup_date_regex', 'dq_name_len', 'dq_email_len',
                                'dq_age_min', 'dq_age_max', 'dq_country_valid_set', 'dq_country_len'])} FROM s3""",
        "lineitem_checks": f"WITH s AS ({_LI}) SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, {_flags(_LI_IDS)} FROM s",
        "lineitem_summary": _suite_numeric_min_sql(12),
        "events_checks": f"WITH s AS ({_EV}) SELECT event_id, event_type, {_flags(_EV_IDS)} FROM s",
        "events_quality_by_day": f"""WITH s AS ({_EV}),
            e AS ({' UNION ALL '.join(f"SELECT ts, '{rid}' AS rule_id, coalesce(f{i}, false) AS ok FROM s" for i, rid in enumerate(_EV_IDS, start=1))})
            SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                   rule_id, count(*) FILTER (WHERE ok) AS n_pass, count(*) FILTER (WHERE NOT ok) AS n_fail, count(*) AS n_rows
            FROM e GROUP BY ALL""",
        "documents_checks": f"""WITH s AS (SELECT doc_id, n_chars,
              length(text) BETWEEN 50 AND 20000 AS f1, regexp_matches(text, '{MAIL_IN_TEXT}') AS f2,
              lang IN ('en', 'de', 'fr') AS f3, n_chars >= 100 AS f4,
              length(lower(trim(text, ' '))) BETWEEN 50 AND 20000 AS f5,
              regexp_matches(lower(trim(text, ' ')), '{MAIL_IN_LOWER_TEXT}') AS f6 FROM documents)
            SELECT doc_id, n_chars, {_flags(['doc_len_raw', 'doc_has_mail', 'doc_lang_set', 'doc_nchars_min', 'doc_len_clean', 'doc_has_mail_lower'])} FROM s""",
        "pages_checks": f"""WITH s AS (SELECT page_id, upper(url) AS url, regexp_matches(url, '{HTTPS_URL}') AS f1,
              length(url) <= 45 AS f2, length(html) >= 1000 AS f3, regexp_matches(upper(url), '^HTTP://') AS f4 FROM pages)
            SELECT page_id, url, {_flags(['url_https', 'url_len', 'html_len', 'url_upper_http'])} FROM s""",
        "orders_checks": f"""WITH s AS ({_ORD})
            SELECT o_orderkey, o_orderpriority, {_flags(['ord_status_set', 'ord_priority_fmt', 'ord_price_range', 'ord_cust_min', 'ord_priority_len', 'ord_priority_lower'])} FROM s""",
        "conversations_checks": f"""WITH s AS (SELECT conv_id, turn, upper(role) AS role,
              role IN ('user', 'assistant') AS f1, length(text) BETWEEN 30 AND 1000 AS f2,
              regexp_matches(text, '[.!]') AS f3, turn <= 6 AS f4,
              upper(role) IN ('USER', 'ASSISTANT', 'SYSTEM') AS f5,
              length(trim(text, ' ')) BETWEEN 30 AND 1000 AS f6 FROM conversations)
            SELECT conv_id, turn, role, {_flags(['conv_role_set', 'conv_text_len', 'conv_text_sentence', 'conv_turn_max', 'conv_role_upper', 'conv_text_len_clean'])} FROM s""",
        "lineitem_references": f"""WITH s AS (SELECT l_orderkey, l_linenumber,
              l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25) AS f1,
              l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AS f2,
              l_orderkey IN (SELECT o_orderkey FROM orders) AS f3 FROM lineitem)
            SELECT l_orderkey, l_linenumber, {_flags(['li_part_small', 'li_supp_solvent', 'li_order_known'])} FROM s""",
        "orders_customer_ref": f"""SELECT o_orderkey, o_custkey,
              {_st('o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)', 'ord_cust_good')} FROM orders""",
        "lineitem_sets": f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_linenumber IN (1, 2, 3) AS f1, l_quantity IN (10, 20, 30, 40.5) AS f2,
              CAST(l_tax AS DECIMAL(10, 2)) IN (0.01, 0.06, 0.08) AS f3,
              CAST(l_shipdate AS DATE) IN (DATE '1995-03-15', DATE '1996-06-30') AS f4 FROM lineitem)
            SELECT l_orderkey, l_linenumber, {_flags(['int_set', 'double_set', 'decimal_set', 'date_set'])} FROM s""",
        "events_quality_untimed": f"""WITH s AS (SELECT * REPLACE (CASE WHEN event_id % 7 <> 0 THEN ts END AS ts) FROM ({_EV})),
            e AS ({' UNION ALL '.join(f"SELECT ts, '{rid}' AS rule_id, coalesce(f{i}, false) AS ok FROM s" for i, rid in enumerate(_EV_IDS, start=1))})
            SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                   rule_id, count(*) FILTER (WHERE ok) AS n_pass, count(*) FILTER (WHERE NOT ok) AS n_fail, count(*) AS n_rows
            FROM e GROUP BY ALL""",
        "documents_profile": """WITH d AS (SELECT * FROM documents),
            p(ordinal, name, kind, nulls, len, lo, hi, pattern, vals) AS (
              SELECT 0, 'doc_id', 'n', count(*) - count(doc_id), NULL, min(doc_id), max(doc_id), NULL, NULL FROM d
              UNION ALL SELECT 1, 'text', 't', count(*) - count(text), max(length(text)), NULL, NULL, NULL, NULL FROM d
              UNION ALL SELECT 2, 'lang', 't', count(*) - count(lang), max(length(lang)), NULL, NULL, '^[a-z]{2}$', 'en,de,fr,es' FROM d
              UNION ALL SELECT 3, 'source', 't', count(*) - count(source), max(length(source)), NULL, NULL, NULL, NULL FROM d
              UNION ALL SELECT 4, 'n_chars', 'n', count(*) - count(n_chars), NULL, min(n_chars), max(n_chars), NULL, NULL FROM d),
            r AS (
              SELECT 1 AS stage_no, 'Ingestion Quality' AS stage_name, 'dq' AS stage_type, ordinal, 1 AS rule_pos, 'dq_' || name || '_not_null' AS id,
                'check_not_null' AS type, name, NULL AS pattern, NULL AS value, NULL AS vals, NULL AS min_len, NULL AS max_len FROM p WHERE nulls = 0
              UNION ALL SELECT 1, 'Ingestion Quality', 'dq', ordinal, 2, 'dq_' || name || '_regex', 'check_regex', name, pattern, NULL, NULL, NULL, NULL FROM p WHERE pattern IS NOT NULL
              UNION ALL SELECT 2, 'Standardization', 'cleanse', ordinal, 3, NULL, 'clean_trim', name, NULL, NULL, NULL, NULL, NULL FROM p WHERE kind = 't'
              UNION ALL SELECT 3, 'Business Logic Verification', 'dq', ordinal, 5, 'dq_' || name || '_min', 'check_min', name, NULL, lo, NULL, NULL, NULL FROM p WHERE lo IS NOT NULL
              UNION ALL SELECT 3, 'Business Logic Verification', 'dq', ordinal, 6, 'dq_' || name || '_max', 'check_max', name, NULL, hi, NULL, NULL, NULL FROM p WHERE hi IS NOT NULL
              UNION ALL SELECT 3, 'Business Logic Verification', 'dq', ordinal, 7, 'dq_' || name || '_valid_set', 'check_in_set', name, NULL, NULL, vals, NULL, NULL FROM p WHERE vals IS NOT NULL
              UNION ALL SELECT 3, 'Business Logic Verification', 'dq', ordinal, 8, 'dq_' || name || '_len', 'check_length', name, NULL, NULL, NULL, 0, len FROM p WHERE kind = 't' AND len IS NOT NULL)
            SELECT CAST(stage_no AS INTEGER) AS stage_no, stage_name, stage_type, CAST(ordinal AS BIGINT) AS ordinal, CAST(rule_pos AS INTEGER) AS rule_pos,
              id, type, name AS "column", pattern, CAST(value AS BIGINT) AS value, vals AS "values", CAST(min_len AS INTEGER) AS min_len,
              CAST(max_len AS INTEGER) AS max_len FROM r""",
        "csv_scan": f"{_COMPLEX_CTES} SELECT CAST(id AS VARCHAR) AS id, name, email, age, country, signup_date, "
        + ", ".join(_st(f"coalesce(f{i}, false)", rid) for i, rid in enumerate(_COMPLEX_IDS, start=1)) + " FROM s3",
        "report_tables": f"{_COMPLEX_CTES}, e AS ({_COMPLEX_EXPLODED}) SELECT *, n_fail AS n_fail_flat FROM ({_SUMMARY_OF_E})",
        "split_counts": f"""WITH s AS ({_ORD}), c AS (SELECT o_orderkey, {' + '.join(f"CASE WHEN coalesce(f{i}, false) THEN 0 ELSE 1 END" for i in range(1, 7))} AS n FROM s)
            SELECT CASE WHEN n = 0 THEN 'true' ELSE 'false' END AS passed, CAST(n AS INTEGER) AS n_failed, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys
            FROM c GROUP BY ALL""",
        "observed_counts": f"WITH s AS ({_EV}) " + " UNION ALL ".join(
            f"SELECT '{rid}' AS rule_id, count(*) FILTER (WHERE f{i}) AS n_pass, count(*) AS n_rows FROM s" for i, rid in enumerate(_EV_IDS, start=1)),
        "orders_unique": f"""WITH o AS (SELECT *, CASE WHEN o_totalprice > 300000 THEN o_orderstatus END AS big FROM orders),
            s AS (SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderkey) = 1 AS f1,
              count(*) OVER (PARTITION BY o_custkey, o_orderdate) = 1 AS f2, count(*) OVER (PARTITION BY o_orderpriority) = 1 AS f3,
              big IS NOT NULL AND count(*) OVER (PARTITION BY big, o_custkey) = 1 AS f4 FROM o)
            SELECT o_orderkey, {_flags(['ord_key_once', 'ord_cust_day_once', 'ord_priority_once', 'ord_clerk_once'])} FROM s""",
        "documents_unique": f"SELECT doc_id, {_st('text IS NOT NULL AND count(*) OVER (PARTITION BY text) = 1', 'doc_text_once')} FROM documents",
        "orders_reconcile": f"""WITH n AS ({ORDERS_LATER.format(orders='orders')}),
            k AS (SELECT o_orderkey, count(*) AS c FROM n GROUP BY o_orderkey),
            j AS (SELECT coalesce(o.o_orderkey, k.o_orderkey) AS o_orderkey, o.o_orderkey IS NOT NULL AS was, coalesce(k.c, 0) AS c,
                o.o_custkey IS DISTINCT FROM n.o_custkey AS d1, o.o_orderstatus IS DISTINCT FROM n.o_orderstatus AS d2,
                o.o_totalprice IS DISTINCT FROM n.o_totalprice AS d3, o.o_orderdate IS DISTINCT FROM n.o_orderdate AS d4,
                o.o_orderpriority IS DISTINCT FROM n.o_orderpriority AS d5
              FROM orders o FULL JOIN k ON k.o_orderkey = o.o_orderkey LEFT JOIN (SELECT DISTINCT * FROM n) n ON n.o_orderkey = k.o_orderkey),
            h AS (SELECT *, CASE WHEN NOT was THEN 'added' WHEN c = 0 THEN 'removed' WHEN NOT (d1 OR d2 OR d3 OR d4 OR d5) AND c > 1 THEN 'repeated'
                WHEN d1 OR d2 OR d3 OR d4 OR d5 THEN 'changed' ELSE 'same' END AS change FROM j)
            SELECT o_orderkey, change, CASE WHEN change <> 'changed' THEN ''
                WHEN c > 1 THEN 'o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority'
                ELSE concat_ws(',', CASE WHEN d1 THEN 'o_custkey' END, CASE WHEN d2 THEN 'o_orderstatus' END, CASE WHEN d3 THEN 'o_totalprice' END,
                  CASE WHEN d4 THEN 'o_orderdate' END, CASE WHEN d5 THEN 'o_orderpriority' END) END AS changed_columns,
              CAST(CASE WHEN was THEN 1 ELSE 0 END AS BIGINT) AS n_old, CAST(c AS BIGINT) AS n_new FROM h WHERE change <> 'same'""",
        "lineitem_periods": f"""WITH s AS (SELECT l_orderkey, l_linenumber,
              EXISTS (SELECT 1 FROM orders o WHERE o.o_totalprice > 480000 AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 7 DAY) AS f1,
              EXISTS (SELECT 1 FROM orders o WHERE o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 30 DAY) AS f2,
              EXISTS (SELECT 1 FROM customer WHERE l_extendedprice BETWEEN c_acctbal * 10 AND c_acctbal * 10 + 25) AS f3 FROM lineitem)
            SELECT l_orderkey, l_linenumber, {_flags(['li_in_big_week', 'li_in_own_month', 'li_price_band'])} FROM s""",
        "events_sequence": f"""WITH s AS (SELECT event_id,
              coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) >= 0, true) AS f1,
              count(*) OVER (PARTITION BY user_id, ts) = 1 AND coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= 43200000000, true) AS f2,
              coalesce(event_id - lag(event_id) OVER (ORDER BY event_id) = 1, event_id = 0) AS f3,
              coalesce(value - lag(value) OVER (PARTITION BY event_type ORDER BY event_id) >= 0, true) AS f4 FROM events)
            SELECT event_id, {_flags(['ev_no_step_back', 'ev_within_hours', 'ev_id_no_gap', 'ev_value_rises'])} FROM s""",
        "conversations_sequence": f"""WITH s AS (SELECT conv_id, turn, coalesce(turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) = 1, turn = 0) AS f1
              FROM conversations WHERE role <> 'system') SELECT conv_id, turn, {_flags(['turn_follows'])} FROM s""",
        "lineitem_rollup": f"""WITH s AS ({_LI}), e AS ({' UNION ALL '.join(f"SELECT l_returnflag, l_linestatus, '{rid}' AS rule_id, coalesce(f{i}, false) AS ok FROM s" for i, rid in enumerate(_LI_IDS, start=1))})
            SELECT l_returnflag, l_linestatus, GROUPING(l_returnflag, l_linestatus) AS level, rule_id, count(*) FILTER (WHERE ok) AS n_pass,
              count(*) FILTER (WHERE NOT ok) AS n_fail, count(*) AS n_rows, CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / count(*) AS pass_rate
            FROM e GROUP BY rule_id, ROLLUP (l_returnflag, l_linestatus)""",
        "lineitem_worst": f"""WITH s AS ({_LI}), e AS ({' UNION ALL '.join(f"SELECT l_orderkey, l_linenumber, l_extendedprice, '{rid}' AS rule_id FROM s WHERE NOT coalesce(f{i}, false)" for i, rid in enumerate(_LI_IDS, start=1))}),
            r AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM e)
            SELECT rule_id, CAST(rank AS INTEGER) AS rank, l_orderkey, l_linenumber FROM r WHERE rank <= 25""",
        "events_json": f"""WITH e AS (SELECT event_id, {PROPS} AS props, event_id % 9 AS m FROM events),
            j AS (SELECT event_id, m, CASE WHEN props IS NOT NULL AND json_valid(props) AND props <> '' THEN props END AS p FROM e),
            s AS (SELECT event_id, p IS NOT NULL AND coalesce(json_type(p, '$.k') IN ('UBIGINT', 'BIGINT'), true) AS f1,
              TRY_CAST(json_extract_string(p, '$.k') AS INTEGER) BETWEEN 20 AND 80 AS f2,
              length(json_extract_string(p, '$.user.name')) >= 3 AS f3 FROM j)
            SELECT event_id, {_flags(['ev_props_shape', 'ev_k_range', 'ev_user_named'])} FROM s""",
        "embeddings_each": f"""WITH s AS (SELECT vec_id, list_filter(range(len(embedding)), lambda i: NOT coalesce(embedding[i + 1] BETWEEN CAST(-0.25 AS DOUBLE) AND CAST(0.25 AS DOUBLE), false)) AS bad,
              len(list_filter(embedding, lambda x: x IS NULL)) = 0 AS f2 FROM embeddings)
            SELECT vec_id, {_st('len(bad) = 0', 'emb_small')}, {_st('f2', 'emb_there')}, CASE WHEN len(bad) > 0 THEN list_aggregate(bad, 'string_agg', ',') END AS places FROM s""",
        "lineitem_outliers": """WITH u AS (UNPIVOT (SELECT l_extendedprice, l_quantity, l_discount FROM lineitem) ON l_extendedprice, l_quantity, l_discount INTO NAME c VALUE v),
            r AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS i, count(*) OVER (PARTITION BY c) AS n FROM u),
            q AS (SELECT c, max(v) FILTER (WHERE i = CAST(ceil(0.25 * n) AS BIGINT)) AS lo, max(v) FILTER (WHERE i = CAST(ceil(0.75 * n) AS BIGINT)) AS hi FROM r GROUP BY c),
            b AS (SELECT c, lo - (hi - lo) * CAST(0.5 AS DOUBLE) AS lo, hi + (hi - lo) * CAST(0.5 AS DOUBLE) AS hi FROM q)
            SELECT 'outlier_' || b.c AS rule_id, b.lo AS "min", b.hi AS "max", count(*) FILTER (WHERE v BETWEEN b.lo AND b.hi) AS n_pass,
              count(*) FILTER (WHERE NOT v BETWEEN b.lo AND b.hi) AS n_fail FROM u JOIN b ON b.c = u.c GROUP BY ALL""",
        "events_profile": """WITH e AS (SELECT strftime(ts, '%Y-%m') AS month, user_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)
            SELECT month, 'user_id' AS "column", count(*) AS n_rows, count(*) - count(user_id) AS n_nulls, CAST(min(user_id) AS DOUBLE) AS lo,
              CAST(max(user_id) AS DOUBLE) AS hi, count(DISTINCT user_id) AS n_exact, true AS close FROM e GROUP BY month
            UNION ALL SELECT month, 'value', count(*), count(*) - count(value), min(value), max(value), count(DISTINCT value), true FROM e GROUP BY month""",
        "events_matched": _MATCHED,
        "events_matched_stream": _MATCHED,
        "events_repeats": _REPEATS,
        "events_repeats_stream": _REPEATS,
        **(_llm.SQL if _llm else {}),
        **({"pipeline": _pipeline.ORACLE_SQL} if _pipeline and _pipeline.ORACLE_SQL else {}),
    }
