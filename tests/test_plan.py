import pytest
from pyspark.sql import functions as F

from tablecheck.catalog.quality import PLAN, plan_frame
from tablecheck.operators import checks as ck
from tablecheck.operators import metrics as m
from tablecheck.plans import quality as q
from tablecheck.sources.results import INDICATOR, PERCENT, STAMP, VALUE


def case(kind, column="boat_id", table="boats", **more):
    return {"tipo": kind, "columna": column, "tabla": table, "schema": "s", **more}


@pytest.fixture()
def resolve(boats, trips):
    seen = []

    def find(schema, name):
        seen.append((schema, name))
        return {"boats": boats, "trips": trips}[name]

    find.seen = seen
    return find


def run(spark, tests, resolve, **options):
    rows = q.run_plan(spark, plan_frame(spark, tests), resolve, **options).collect()
    return {r["indicator"]: (r["value"], r["message"]) for r in rows}


@pytest.mark.parametrize("isolate", [False, True])
def test_every_type(spark, resolve, isolate):
    tests = [
        case(q.CURRENCY, "launched", tiempo_limite="01/01/2021", tipo_actualidad=q.BY_DATE),
        case(q.INTEGRITY, columna_2="boat", tabla_2="trips"),
        case(q.ACCURACY, "berth", patron=r"^B-\d{3}$", tipo_exactitud=q.SYNTACTIC),
        case(q.ACCURACY, "class", patron="barge , ferry", tipo_exactitud=q.SEMANTIC),
        case(q.CREDIBILITY, "class", patron="sail", tipo_credibilidad=q.BY_VALUES),
        case(q.CREDIBILITY, "contact", patron=r"@\w+\.boat$", tipo_credibilidad=q.BY_PATTERN),
        case(q.CURRENCY, "launched", tiempo_limite="2022-06-01 00:00:00", tipo_actualidad=q.BY_DATE_TIME),
        case(q.PRECISION, "crew", num_decimales="0"),
        case(q.COMPLETENESS, "harbour"),
    ]
    rows = q.run_plan(spark, plan_frame(spark, tests), resolve, isolate=isolate).collect()
    got = sorted((r["indicator"], r["value"]) for r in rows)
    assert got == sorted(
        [
            ("Completitud_boats_harbour", 5 / 7),
            ("Credibilidad_Patron_boats_contact", 4 / 7),
            ("Credibilidad_Conjunto valores_boats_class", 4 / 7),
            ("Exactitud_Sintactica_boats_berth", 5 / 7),
            ("Exactitud_Semantica_boats_class", 1 / 7),
            ("Precision_boats_crew", 6 / 7),
            ("Integridad Referencial_boats_trips_boat_id", 3 / 7),
            ("Actualidad_boats_launched", 4 / 7),
            ("Actualidad_boats_launched", 2 / 7),
        ]
    )
    # A table is resolved once, however many tests it has.
    assert sorted(resolve.seen) == [("s", "boats"), ("s", "trips")]


def test_tests_of_a_table_share_one_aggregation(spark, resolve):
    tests = [case(q.COMPLETENESS, c) for c in ("boat_id", "title", "contact", "harbour", "class")]
    df = q.run_plan(spark, plan_frame(spark, tests), resolve)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_a_column_that_raises_fails_its_own_test_only(spark, boats, trips):
    bad = boats.withColumn("hull", F.expr("cast(hull as int)"))
    tests = [case(q.COMPLETENESS, "hull"), case(q.COMPLETENESS, "harbour"), case(q.COMPLETENESS, "stage", "trips")]
    rows = run(spark, tests, lambda s, n: {"boats": bad, "trips": trips}[n], isolate=True)
    assert rows["Completitud_boats_harbour"] == (5 / 7, None) and rows["Completitud_trips_stage"] == (1.0, None)
    assert rows["Completitud_boats_hull"][0] is None and rows["Completitud_boats_hull"][1]


@pytest.mark.parametrize(
    ("test", "error"),
    [
        (case("Otro"), "unknown test type"),
        ({**case(q.COMPLETENESS), "tipo": None}, "unknown test type"),
        (case(q.COMPLETENESS, "  "), "table and column are required"),
        (case(q.CREDIBILITY, patron="  ", tipo_credibilidad=q.BY_PATTERN), "pattern is required"),
        (case(q.CREDIBILITY, patron="a"), "unknown subtype"),
        (case(q.ACCURACY, patron="a", tipo_exactitud="Otra"), "unknown subtype"),
        (case(q.ACCURACY, tipo_exactitud=q.SEMANTIC), "pattern is required"),
        (case(q.PRECISION), "number of decimals must be an integer"),
        (case(q.PRECISION, num_decimales="-1"), "number of decimals must be an integer"),
        (case(q.INTEGRITY, tabla_2="trips"), "second table and column are required"),
        (case(q.CURRENCY, tipo_actualidad=q.BY_DATE, tiempo_limite=" "), "limit is required"),
        (case(q.CURRENCY, tipo_actualidad="Hora", tiempo_limite="2020-01-01"), "unknown subtype"),
        (case(q.CURRENCY, tipo_actualidad=q.BY_DATE, tiempo_limite="soon"), "limit is not a date"),
    ],
)
def test_validation(spark, resolve, test, error):
    plan = plan_frame(spark, [test, case(q.COMPLETENESS)])
    assert [r["error"] for r in q.validate_plan(plan).collect()] == [error]
    rows = run(spark, [test, case(q.COMPLETENESS)], resolve)
    assert rows.pop("Completitud_boats_boat_id") == (1.0, None)
    assert list(rows.values()) == [(None, error)]


def test_valid_plan_has_no_errors(spark):
    assert q.validate_plan(plan_frame(spark, PLAN)).count() == 0
    assert len(PLAN) == 14


def test_errors_do_not_stop_the_other_tests(spark, resolve):
    tests = [
        case(q.COMPLETENESS, "mast"),
        case(q.COMPLETENESS, "title", "nowhere"),
        case(q.INTEGRITY, columna_2="x", tabla_2="nowhere"),
        case(q.INTEGRITY, columna_2="no_key", tabla_2="trips"),
        case(q.CREDIBILITY, "contact", patron="(", tipo_credibilidad=q.BY_PATTERN),
        case(q.COMPLETENESS, "title"),
    ]
    rows = run(spark, tests, resolve)
    assert rows.pop("Completitud_boats_title") == (1.0, None)
    assert len(rows) == 5
    assert all(value is None and message for value, message in rows.values())


def test_empty_plan(spark, resolve):
    assert run(spark, [], resolve) == {}


def test_result_format(spark, resolve):
    tests = [case(q.COMPLETENESS, "harbour"), case(q.COMPLETENESS, "mast")]
    df = q.format_results(q.run_plan(spark, plan_frame(spark, tests), resolve), "2024-11-05 07:08:09")
    assert df.columns == [INDICATOR, VALUE, PERCENT, STAMP]
    assert [tuple(r) for r in df.collect()] == [("Completitud_boats_harbour", 5 / 7, "71%", "2024-11-05_07:08")]


def test_column_names_with_spaces(spark):
    df = spark.createDataFrame([("a", 1.25), (None, 2.0)], ["Nombre del año", "valor.total"])
    tests = [case(q.COMPLETENESS, "Nombre del año", "t"), case(q.PRECISION, "valor.total", "t", num_decimales="2")]
    rows = run(spark, tests, lambda s, n: df)
    assert [v for v, _ in rows.values()] == [0.5, 0.5]


def test_report(boats):
    metrics = m.run_metrics(boats, [m.completeness("harbour"), m.minimum("crew")])
    checks = ck.run_checks(boats, [ck.Check(ck.ERROR, "classes", m.is_contained_in("class", ["sail"]))])
    rows = {(r["source"], r["name"]): r["percent"] for r in q.report(metrics, checks).collect()}
    # A minimum is not a ratio and has no percentage.
    assert rows == {("analysis", "Completeness"): "71%", ("analysis", "Minimum"): None, ("check", "Compliance"): "57%"}


def test_frames_resolver(spark, boats):
    tests = [case(q.COMPLETENESS, "harbour"), case(q.COMPLETENESS, "title", "other")]
    rows = run(spark, tests, q.frames_resolver({"boats": boats}))
    assert rows["Completitud_boats_harbour"] == (5 / 7, None)
    assert rows["Completitud_other_title"][0] is None


def test_jdbc_resolver_names_the_table(spark, boats, monkeypatch):
    calls = []

    def read(_spark, dialect, host, database, table, user, password, partition=None):
        calls.append((dialect, table, partition))
        return boats

    monkeypatch.setattr(q, "read_jdbc", read)
    part = q.JdbcPartition("boat_id", 1, 7, 4)
    resolve = q.jdbc_resolver(spark, "mysql", "db", "shop", "u", "p", {"boats": part})
    run(spark, [case(q.COMPLETENESS), case(q.COMPLETENESS, "title", "small")], resolve)
    assert calls == [("mysql", "s.boats", part), ("mysql", "s.small", None)]
