"""A deterministic "dirty" view over the TPC-H-style ``customer`` table.

The driver tables hold no NULLs and no padded text, so the checks would
never fail on them.  This view reshapes ``customer`` into the sample
customers' columns (id, name, email, age, country, signup_date) with NULLs,
padding, mixed case, malformed mail, non-numeric and out-of-range ages,
unknown countries and a wrong date separator, all from the key alone, so the
same text in any SQL engine gives the same rows.  One row in, one row out:
it scales with ``customer`` and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# The view's columns as SQL expressions.  The same text runs
# on Spark (``selectExpr``) and DuckDB (``DIRTY_CUSTOMERS_SQL``).
DIRTY_COLUMNS = [
    "c_custkey AS id",
    "CASE WHEN c_custkey % 11 = 0 THEN 'E' WHEN c_custkey % 11 = 1 THEN concat('  ', c_name, ' ') ELSE c_name END AS name",
    """CASE c_custkey % 7 WHEN 0 THEN NULL
   WHEN 1 THEN concat('  User.', cast(c_custkey AS string), '@Example.com ')
   WHEN 2 THEN concat('user', cast(c_custkey AS string))
   WHEN 3 THEN concat('User', cast(c_custkey AS string), '@Example.com')
   ELSE concat('user', cast(c_custkey AS string), '@example.com') END AS email""",
    """CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN '150' WHEN 3 THEN '17'
   ELSE cast(18 + c_custkey % 60 AS string) END AS age""",
    """CASE c_custkey % 9 WHEN 0 THEN 'USA' WHEN 1 THEN 'uk' WHEN 2 THEN 'CA' WHEN 3 THEN 'au'
   WHEN 4 THEN 'DE' WHEN 5 THEN 'FR' WHEN 6 THEN NULL ELSE 'usa' END AS country""",
    """CASE WHEN c_custkey % 5 = 0 THEN '2023/01/03' WHEN c_custkey % 5 = 1 THEN NULL
   ELSE concat('2023-01-0', cast(c_custkey % 9 + 1 AS string)) END AS signup_date""",
]

DIRTY_CUSTOMERS_SQL = "SELECT " + ",\n ".join(DIRTY_COLUMNS) + "\nFROM customer"


def dirty_customers(customer: DataFrame) -> DataFrame:
    """The view over a ``customer`` DataFrame (one projection, no shuffle)."""
    return customer.selectExpr(*DIRTY_COLUMNS)
