"""Keys in bulk: bitmaps for references, a second pass for long texts only for uniqueness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bitmaps, keys
from ..operators.windows import union_frames
from .data import query, table
from .quality import TYPED_SQL, typed_texts


def _integrity_sql(name: str, child: str, col: str, parent: str, col2: str) -> str:
    found = f"count(*) FILTER (WHERE {col} IN (SELECT {col2} FROM {parent} WHERE {col2} IS NOT NULL))"
    return f"SELECT '{name}' AS reference, count(*) AS total, {found} AS matched, CAST({found} AS DOUBLE) / count(*) AS value FROM {child}"


@query(
    "integrity_bitmaps",
    " UNION ALL ".join(
        [
            _integrity_sql("items to orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            _integrity_sql("items to finished orders", "lineitem", "l_orderkey", "(SELECT * FROM orders WHERE o_orderstatus = 'F')", "o_orderkey"),
            _integrity_sql("customers to orders", "customer", "c_custkey", "orders", "o_custkey"),
            _integrity_sql("orders to large parts", "orders", "o_custkey", "(SELECT * FROM part WHERE p_size > 25)", "p_partkey"),
            _integrity_sql("texts to customers", TYPED_SQL, "try_cast(key_text AS BIGINT)", "customer", "c_custkey"),
        ]
    ),
)
def integrity_bitmaps(spark, d):
    """References of whole numbers by bitmaps, the last one, of texts, by keys."""
    items, orders, customers = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    large = table(spark, d, "part").filter("p_size > 25")
    asked = {
        "items to orders": (items, orders, "l_orderkey", "o_orderkey"),
        "items to finished orders": (items, orders.filter("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey"),
        "customers to orders": (customers, orders, "c_custkey", "o_custkey"),
        "orders to large parts": (orders, large, "o_custkey", "p_partkey"),
        "texts to customers": (typed_texts(spark, d), customers, "key_text", "c_custkey"),
    }
    return union_frames([bitmaps.integrity(*a).select(F.lit(n).alias("reference"), "*") for n, a in asked.items()])


@query(
    "orphans_bitmaps",
    """SELECT l_orderkey AS key, count(*) AS n FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice < 400000) GROUP BY 1""",
)
def orphans_bitmaps(spark, d):
    """Keys of items whose order is none of the cheaper ones."""
    cheap = table(spark, d, "orders").filter("o_totalprice < 400000")
    return bitmaps.orphan_keys(table(spark, d, "lineitem"), cheap, "l_orderkey", "o_orderkey")


def _uniqueness_sql(source: str, key: str) -> str:
    some = " OR ".join(f"{c} IS NOT NULL" for c in key.split(","))
    return f"""SELECT '{key}' AS instance, 'Uniqueness' AS name, CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n) AS value
FROM (SELECT count(*) AS n FROM {source} WHERE {some} GROUP BY {key})"""


ITEM_KEYS = ("l_orderkey,l_linenumber", "l_orderkey,l_partkey", "l_extendedprice", "l_shipdate", "l_suppkey")
WITH_GAPS = "(SELECT *, nullif(l_returnflag, 'N') AS flag, nullif(l_linestatus, 'O') AS status FROM lineitem)"


@query(
    "uniqueness_two_pass",
    " UNION ALL ".join(
        [*[_uniqueness_sql("lineitem", k) for k in ITEM_KEYS], _uniqueness_sql(WITH_GAPS, "l_orderkey,flag"),
         _uniqueness_sql(WITH_GAPS, "flag,status"), _uniqueness_sql("documents", "text")]
    ),
)
def uniqueness_two_pass(spark, d):
    """Seven keys of numbers, days and short texts, each counted in one pass; long texts of another table are moved whole only if their hash repeats."""
    gaps = table(spark, d, "lineitem").withColumns(
        {"flag": F.nullif("l_returnflag", F.lit("N")), "status": F.nullif("l_linestatus", F.lit("O"))}
    )
    sets = [k.split(",") for k in (*ITEM_KEYS, "l_orderkey,flag", "flag,status")]
    return union_frames([keys.uniqueness(gaps, sets), keys.uniqueness(table(spark, d, "documents"), ["text"])])


@query(
    "constraints_two_pass",
    """WITH o AS (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)
SELECT 'orders' AS table_name, 'pk(o_orderkey)' AS constraint, count(*) - count(DISTINCT o_orderkey) AS violations FROM o
UNION ALL SELECT 'orders', 'pk(o_custkey,status)', (SELECT count(*) FROM o WHERE status IS NULL) +
  (SELECT count(*) FROM (SELECT 1 FROM o WHERE status IS NOT NULL GROUP BY o_custkey, status HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'unique(o_custkey,status)',
  (SELECT count(*) FROM (SELECT 1 FROM o WHERE status IS NOT NULL GROUP BY o_custkey, status HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'unique(o_totalprice)', (SELECT count(*) FROM (SELECT 1 FROM o GROUP BY o_totalprice HAVING count(*) > 1))""",
)
def constraints_two_pass(spark, d):
    orders = table(spark, d, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return keys.key_constraints(orders, "orders", ["o_orderkey", ["o_custkey", "status"]], [["o_custkey", "status"], "o_totalprice"])
