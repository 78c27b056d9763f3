import datetime as dt
import os
from decimal import Decimal as D

import pytest

from tablecheck.catalog import QUERIES
from tablecheck.operators import data_tests
from tablecheck.operators.joins import on_own_days, on_spine
from tablecheck.operators.spine import date_spine
from tablecheck.plans import marts, staging
from tablecheck.plans.semantic import (
    SAVED_QUERIES, Cumulative, Derived, Input, Key, Measure, MetricCatalog, SemanticModel, Simple, TimeDimension,
    shop_metrics,
)


def test_location_day_is_truncated(spark):
    raw = spark.sql(
        """SELECT * FROM VALUES ('q', 'Quay', 0.035D, timestamp'2011-02-28T18:45:12'),
        ('m', 'Mill', 0.08D, timestamp'2031-12-08T22:10:00.75'), ('n', NULL, NULL, NULL) AS t(id, name, tax_rate, opened_at)"""
    )
    rows = {r["location_id"]: r for r in staging.stg_locations(raw).collect()}
    assert {k: r["opened_date"] for k, r in rows.items()} == {"q": dt.date(2011, 2, 28), "m": dt.date(2031, 12, 8), "n": None}
    assert rows["q"].asDict() == {
        "location_id": "q", "location_name": "Quay", "tax_rate": 0.035, "opened_date": dt.date(2011, 2, 28),
    }


@pytest.fixture(scope="module")
def shop(spark):
    """Raw inputs with gaps: an order without items, an item without product or
    order, a product without supplies, supplies without product, a customer
    without orders and two orders on one day."""
    customers = spark.createDataFrame([("c1", "Ada"), ("c2", "Ben"), ("c3", "Cleo")], "id string, name string")
    orders = spark.createDataFrame(
        [
            ("o1", "s1", "c1", 1500, 90, 1590, "2024-01-31 09:00:00"),
            ("o2", "s1", "c1", 600, 36, 636, "2024-01-31 08:00:00"),
            ("o3", "s2", "c2", 2100, 84, 2184, "2024-02-29 23:59:59"),
            ("o4", "s2", "c1", 0, 0, 0, "2024-03-31 10:00:00"),
        ],
        "id string, store_id string, customer string, subtotal int, tax_paid int, order_total int, ordered_at string",
    ).selectExpr("* EXCEPT (ordered_at)", "timestamp(ordered_at) AS ordered_at")
    items = spark.createDataFrame(
        [
            ("i1", "o1", "food"), ("i2", "o1", "drink"), ("i3", "o2", "drink"), ("i4", "o3", "food"),
            ("i5", "o3", "food"), ("i6", "o3", "gone"), ("i7", "o9", "food"), ("i8", "o3", "ghost"),
        ],
        "id string, order_id string, sku string",
    )
    products = spark.createDataFrame(
        [("food", "Toast", "eat", 1100, "a, b"), ("drink", "Tea", "sip", 400, None), ("bare", "Plain", None, 50, None)],
        "sku string, name string, type string, price int, description string",
    )
    supplies = spark.createDataFrame(
        [("1", "bread", 275, True, "food"), ("2", "leaf", 120, True, "drink"), ("3", "cup", 95, False, "drink"),
         ("4", "lid", 7, False, "ghost")],
        "id string, name string, cost int, perishable boolean, sku string",
    )
    stores = spark.createDataFrame(
        [("s1", "Quay", 0.06, "2011-02-28 18:45:12"), ("s2", "Mill", 0.04, "2013-10-05 07:00:00")],
        "id string, name string, tax_rate double, opened_at string",
    ).selectExpr("* EXCEPT (opened_at)", "timestamp(opened_at) AS opened_at")
    stg = {
        "customers": staging.stg_customers(customers),
        "orders": staging.stg_orders(orders),
        "items": staging.stg_order_items(items),
        "products": staging.stg_products(products, "eat", "sip"),
        "supplies": staging.stg_supplies(supplies),
        "locations": marts.locations(staging.stg_locations(stores)),
    }
    item_mart = marts.order_items(stg["items"], stg["orders"], stg["products"], stg["supplies"])
    order_mart = marts.orders(stg["orders"], item_mart)
    stg |= {"item_mart": item_mart, "order_mart": order_mart, "customer_mart": marts.customers(stg["customers"], order_mart)}
    return stg


def test_staging(shop):
    product = {r["product_id"]: r for r in shop["products"].collect()}
    assert product["food"]["product_price"] == D("11.00")
    assert (product["bare"]["is_food_item"], product["bare"]["is_drink_item"]) == (False, False)
    order = shop["orders"].filter("order_id = 'o1'").first()
    assert (order["subtotal_cents"], order["subtotal"], order["ordered_at"]) == (1500, D("15.00"), dt.date(2024, 1, 31))
    assert shop["supplies"].select("supply_uuid").distinct().count() == 4


def test_supply_costs_sum_per_product(shop):
    cost = {r["order_item_id"]: r["supply_cost"] for r in shop["item_mart"].collect()}
    assert cost == {
        "i1": D("2.75"), "i2": D("2.15"), "i3": D("2.15"), "i4": D("2.75"), "i5": D("2.75"), "i6": None,
        "i7": D("2.75"), "i8": D("0.07"),
    }


def test_item_without_product_or_order_is_kept(shop):
    rows = {r["order_item_id"]: r for r in shop["item_mart"].collect()}
    assert len(rows) == 8
    assert rows["i8"]["product_name"] is None and rows["i8"]["is_food_item"] is None
    assert rows["i7"]["ordered_at"] is None and rows["i7"]["product_name"] == "Toast"


def test_order_counts_become_flags(shop):
    rows = {r["order_id"]: r for r in shop["order_mart"].collect()}
    assert (rows["o1"]["count_food_items"], rows["o1"]["count_drink_items"]) == (1, 1)
    assert (rows["o1"]["is_food_order"], rows["o1"]["is_drink_order"]) == (True, True)
    assert (rows["o3"]["count_food_items"], rows["o3"]["count_drink_items"], rows["o3"]["count_order_items"]) == (2, 0, 4)
    assert (rows["o3"]["is_food_order"], rows["o3"]["is_drink_order"]) == (True, False)
    assert rows["o1"]["order_cost"] == D("4.90") and rows["o1"]["order_items_subtotal"] == D("15.00")
    # No items: NULL counts and flags.
    assert rows["o4"]["count_food_items"] is None and rows["o4"]["is_food_order"] is None
    # Same day: numbered by order id.
    assert [rows[o]["customer_order_number"] for o in ("o1", "o2", "o4", "o3")] == [1, 2, 3, 1]


def test_marts_do_not_change_when_groups_are_split(shop):
    split = marts.orders(shop["orders"], shop["item_mart"], share=0.1, min_rows=1)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, shop["order_mart"].collect()))
    people = marts.customers(shop["customers"], split)
    assert sorted(map(repr, people.collect())) == sorted(map(repr, shop["customer_mart"].collect()))


def test_customers(shop):
    rows = {r["customer_id"]: r for r in shop["customer_mart"].collect()}
    assert (rows["c1"]["count_lifetime_orders"], rows["c1"]["customer_type"]) == (3, "returning")
    assert (rows["c1"]["first_ordered_at"], rows["c1"]["last_ordered_at"]) == (dt.date(2024, 1, 31), dt.date(2024, 3, 31))
    assert (rows["c1"]["lifetime_spend_pretax"], rows["c1"]["lifetime_tax_paid"]) == (D("21.00"), D("1.26"))
    assert rows["c2"]["customer_type"] == "new"
    assert (rows["c3"]["count_lifetime_orders"], rows["c3"]["customer_type"]) == (None, "new")


def test_declared_data_tests(shop):
    assert data_tests.expression_is_true(shop["orders"], "order_total - tax_paid = subtotal").count() == 0
    assert data_tests.expression_is_true(
        shop["customer_mart"], "lifetime_spend_pretax + lifetime_tax_paid = lifetime_spend"
    ).count() == 0
    # NULL passes, so the order without items does not fail.
    failing = data_tests.expression_is_true(shop["order_mart"], "order_items_subtotal = subtotal")
    assert sorted(r["order_id"] for r in failing.collect()) == ["o2", "o3"]
    assert data_tests.accepted_values(shop["customer_mart"], "customer_type", ["new", "returning"]).count() == 0
    lost = data_tests.relationships(shop["item_mart"], "order_id", shop["order_mart"], "order_id")
    assert [r["order_item_id"] for r in lost.collect()] == ["i7"]


@pytest.fixture(scope="module")
def catalog(shop):
    return shop_metrics(shop["item_mart"], shop["order_mart"], shop["customer_mart"], shop["locations"])


def by_day(df):
    return {r["metric_time"]: r for r in df.collect()}


JAN, FEB, MAR = dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)


def test_simple_ratio_and_median(catalog):
    names = ["revenue", "food_revenue", "food_revenue_pct", "median_revenue"]
    rows = by_day(catalog.query_metrics(names, [TimeDimension("day")]))
    assert (rows[JAN]["revenue"], rows[JAN]["food_revenue"], rows[JAN]["median_revenue"]) == (D("19.00"), D("11.00"), 4.0)
    assert rows[JAN]["food_revenue_pct"] == pytest.approx(11 / 19)
    assert rows[FEB]["revenue"] == D("22.00")
    # Items without an order have no day; their group is kept.
    assert rows[None]["revenue"] == D("11.00")


def test_filtered_metrics(catalog):
    names = ["orders", "new_customer_orders", "large_orders", "food_orders", "drink_orders"]
    rows = by_day(catalog.query_metrics(names, [TimeDimension("day")]))
    assert tuple(rows[JAN])[1:] == (2, 1, None, 1, 2)
    assert tuple(rows[FEB])[1:] == (1, 1, 1, 1, None)
    assert tuple(rows[MAR])[1:] == (1, None, None, None, None)


def test_growth_clamps_at_month_ends(catalog):
    rows = by_day(catalog.query_metrics(["revenue_growth_mom"], [TimeDimension("day")]))
    assert rows[FEB]["revenue_growth_mom"] is None  # 29 January has no revenue
    monthly = by_day(catalog.query_metrics(["revenue_growth_mom"], [TimeDimension("month")]))
    assert monthly[dt.date(2024, 2, 1)]["revenue_growth_mom"] == pytest.approx((22 - 19) * 100 / 19)
    with pytest.raises(ValueError, match="time dimension"):
        catalog.query_metrics(["revenue_growth_mom"], [])


def test_profit_spans_two_marts(catalog):
    rows = by_day(catalog.query_metrics(["order_gross_profit"], [TimeDimension("day")]))
    assert rows[JAN]["order_gross_profit"] == D("19.00") - D("7.05")
    assert set(rows) == {JAN, FEB, MAR, None}
    assert rows[MAR]["order_gross_profit"] is None


def test_cumulative_and_totals(catalog):
    rows = by_day(catalog.query_metrics(["cumulative_revenue"], [TimeDimension("day")]))
    assert rows[FEB]["cumulative_revenue"] - rows[JAN]["cumulative_revenue"] == D("22.00")
    total = catalog.query_metrics(["revenue", "cumulative_revenue", "orders"], []).first()
    assert tuple(total) == (D("52.00"), D("52.00"), 4)


def test_derived_inputs_do_not_hide_other_metrics(catalog):
    row = catalog.query_metrics(["orders", "average_order_value", "order_gross_profit"], []).first()
    assert row["orders"] == 4
    assert row["average_order_value"] == pytest.approx(42 / 4)
    # Cost of o1, o2 and o3; the item of the unknown order counts in the revenue only.
    assert row["order_gross_profit"] == D("52.00") - (D("4.90") + D("2.15") + D("5.57"))


def test_entities_and_averages(catalog):
    rows = {r["location"]: r for r in catalog.query_metrics(["order_total", "orders"], [Key("location")]).collect()}
    assert (rows["s1"]["order_total"], rows["s1"]["orders"]) == (D("22.26"), 2)
    average = catalog.query_metrics(["average_tax_rate"], []).first()[0]
    assert average == pytest.approx(0.05)
    types = {r["customer_type"]: r["customers"] for r in catalog.query_metrics(["customers"], [Key("customer_type")]).collect()}
    assert types == {"new": 2, "returning": 1}


def test_saved_query(spark, catalog, tmp_path):
    metrics, group_by = SAVED_QUERIES["customer_order_metrics"]
    df = catalog.saved_query("customer_order_metrics", metrics, group_by, str(tmp_path / "q"))
    rows = {r["customer"]: r["average_order_value"] for r in spark.table("customer_order_metrics").collect()}
    assert df.columns == ["customer", *metrics]
    assert rows == {"c1": pytest.approx(7.0), "c2": pytest.approx(21.0), "c3": None}


def test_measures_of_a_mart_share_one_aggregation(spark):
    frame = spark.range(100).selectExpr("id", "id % 3 AS g", "date'2024-01-01' AS day")
    model = SemanticModel(
        "m", frame, (Measure("total", expr="id"), Measure("n", expr="1"), Measure("kinds", "count_distinct", "g", approx=True)),
        "day", {"g": "g"},
    )
    metrics = [
        Simple("total", "total"), Simple("n", "n"), Simple("kinds", "kinds"), Simple("even", "n", "id % 2 = 0"),
        Derived("mean", "total / count", {"total": Input("total"), "count": Input("n")}), Cumulative("all", "n"),
        Derived("change", "total - before", {"total": Input("total"), "before": Input("total", 1)}),
    ]
    catalog = MetricCatalog([model], metrics)
    df = catalog.query_metrics(["total", "n", "even", "kinds", "mean"], [Key("g")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert sorted(tuple(r) for r in df.collect())[0] == (0, 1683, 34, 17, 1, 49.5)
    dated = catalog.query_metrics(["all", "change"], [TimeDimension("day"), Key("g")]).collect()
    assert {(r["all"], r["change"]) for r in dated} == {(34, None), (33, None)}


def test_date_spine(spark):
    spine = date_spine(spark, "2024-03-01", 3650)
    assert spine.count() == 3651
    assert spine.dtypes == [("date_day", "date")]
    series = spark.createDataFrame([(dt.date(2024, 2, 29), 5)], "day date, v int")
    filled = on_spine(series, date_spine(spark, "2024-03-01", 2), "day")
    assert sorted(tuple(r) for r in filled.collect()) == [
        (dt.date(2024, 2, 28), None), (dt.date(2024, 2, 29), 5), (dt.date(2024, 3, 1), None),
    ]


def test_filled_metrics_have_every_day(spark, catalog):
    spine = date_spine(spark, "2024-03-02", 33)
    rows = by_day(catalog.query_metrics(["revenue", "cumulative_revenue", "revenue_growth_mom"], [TimeDimension("day")], spine))
    assert len(rows) == 34 and None not in rows
    assert rows[dt.date(2024, 2, 10)]["revenue"] is None
    assert rows[dt.date(2024, 2, 10)]["cumulative_revenue"] == D("19.00")
    assert rows[FEB]["cumulative_revenue"] == D("41.00")
    with pytest.raises(ValueError, match="spine"):
        catalog.query_metrics(["revenue"], [TimeDimension("month")], spine)


def test_days_between_are_filled_without_a_shuffle_of_their_own(spark):
    days = [(1, 1, 5), (1, 4, 7), (2, 2, 1), (None, 1, 2), (None, 3, None), (3, None, 9)]
    rows = [(k, None if day is None else dt.date(2024, 2, day), v) for k, day, v in days]
    frame = spark.createDataFrame(rows, "k int, day date, v long")
    catalog = MetricCatalog(
        [SemanticModel("m", frame, (Measure("v"),), "day", {"k": "k"})],
        [Simple("v", "v"), Cumulative("upto", "v"), Derived("twice", "upto * 2", {"upto": Input("upto")}),
         Derived("some", "coalesce(v, 1)", {"v": Input("v")}), Cumulative("some_upto", "some")],
    )
    df = catalog.query_metrics(["v", "upto", "twice"], [TimeDimension("day"), Key("k")], fill=True)
    want = [
        (1, 1, 5, 5), (2, 1, None, 5), (3, 1, None, 5), (4, 1, 7, 12), (2, 2, 1, 1),
        (1, None, 2, 2), (2, None, None, 2), (3, None, None, 2),
    ]
    assert sorted(map(str, df.collect())) == sorted(
        map(str, spark.createDataFrame([(dt.date(2024, 2, d), k, v, u, u * 2) for d, k, v, u in want], df.schema).collect())
    )
    # The days are generated above the last join, sort and shuffle.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.index("Generate") < plan.index("Sort") < plan.index("Exchange")
    # A running total of what is not simple needs the filled days themselves.
    rows = catalog.query_metrics(["some_upto"], [TimeDimension("day"), Key("k")], fill=True).filter("k = 1").collect()
    assert {r["metric_time"].day: r["some_upto"] for r in rows} == {1: 5, 2: 6, 3: 7, 4: 14}


def test_a_day_that_occurs_twice_stays_twice(spark):
    rows = [(dt.date(2024, 2, 1), "a"), (dt.date(2024, 2, 1), "b"), (dt.date(2024, 2, 3), "c"), (None, "d")]
    filled = on_own_days(spark.createDataFrame(rows, "day date, v string"), "day", [])
    assert sorted((r["day"].day, r["v"] or "") for r in filled.collect()) == [(1, "a"), (1, "b"), (2, ""), (3, "c")]


def nodes(df, *names):
    """How often plan nodes occur in the plan that is about to run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [sum(name in line for line in plan.split("\n")) for name in names]


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_marts_read_each_table_once_or_twice(spark, no_broadcast):
    """Also where no side may be broadcast."""
    mart_orders = QUERIES["mart_orders"](spark, SF_DIR)
    shuffles, items, orders = nodes(mart_orders, "Exchange hashpartitioning", "lineitem.parquet", "orders.parquet")
    assert items == 1 and orders <= 3 and shuffles <= 8
    mart_customers = QUERIES["mart_customers"](spark, SF_DIR)
    shuffles, items, orders = nodes(mart_customers, "Exchange hashpartitioning", "lineitem.parquet", "orders.parquet")
    assert items == 0 and orders <= 2 and shuffles <= 4


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_profit_groups_the_items_once(spark, no_broadcast):
    for name in ("metric_profit", "metric_grains_by_month"):
        shuffles, items, orders = nodes(QUERIES[name](spark, SF_DIR), "Exchange hashpartitioning", "lineitem.parquet", "orders.parquet")
        assert items == 1 and orders == 1 and shuffles <= 7, name


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_building_a_query_starts_few_jobs(spark):
    """Beside the jobs that read file schemas, only the list of hot keys."""
    tracker = spark.sparkContext.statusTracker()

    def started(build):
        spark.sparkContext.setJobGroup("building", "building")
        before = set(tracker.getJobIdsForGroup("building"))
        build()
        jobs = set(tracker.getJobIdsForGroup("building")) - before
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(jobs)

    schemas = started(lambda: [spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("events", "orders", "lineitem", "documents")])
    assert schemas <= 4
    for name in ("violation_counts", "expect_unique", "rows_in", "test_relationships", "orphan_keys", "mart_order_items", "mart_customers"):
        reads = {"mart_order_items": 4, "mart_customers": 5 + 4}.get(name, 2)
        assert started(lambda name=name: QUERIES[name](spark, SF_DIR)) <= reads, name
    # The file's schema, the number of rows, and the rows per key: the latter two run as two jobs each.
    assert started(lambda: QUERIES["order_ordinal"](spark, SF_DIR)) <= 1 + 4
