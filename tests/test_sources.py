import json
import os

import pytest
from pyspark.sql import functions as F

from tablecheck.plans.history import evolution, evolution_table, union_history
from tablecheck.sources import files, jdbc, plan_files, results, scratch, tables


def test_csv_is_text_with_null_tokens(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Nombre indicador;Año de alta;n\nA b;;1\nNULL;null;NaN\n'x';2020;\n", encoding="utf-8")
    df = files.read_csv(spark, str(path))
    assert df.dtypes == [("Nombre indicador", "string"), ("Año de alta", "string"), ("n", "string")]
    assert [tuple(r) for r in df.collect()] == [("A b", None, "1"), (None, None, None), ("'x'", "2020", None)]


def test_json_array_and_lines(spark, tmp_path):
    rows = [{"año": "x", "n": 1, "d": 1.5}, {"año": "NaN", "n": 2, "d": None}]
    array = tmp_path / "a.json"
    array.write_text(json.dumps(rows, indent=2), encoding="utf-8")
    df = files.read_json(spark, str(array))
    assert dict(df.dtypes) == {"año": "string", "n": "bigint", "d": "double"}
    assert [r["año"] for r in df.orderBy("n").collect()] == ["x", None]
    lines = tmp_path / "l.json"
    lines.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    typed = files.read_json(spark, str(lines), lines=True, schema="`año` string, n int, d double")
    assert [tuple(r) for r in typed.orderBy("n").collect()] == [("x", 1, 1.5), (None, 2, None)]


def test_numeric_nan_is_left_alone(spark):
    df = files.normalize_nulls(spark.createDataFrame([(float("nan"), "NaN")], "d double, s string"))
    row = df.first()
    assert row["d"] != row["d"] and row["s"] is None


def test_seed_with_quoted_commas(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('sku,price,description\nA-1,1100,"one, two"\nA-2,5,"say ""hi"""\n')
    df = files.load_seed(spark, str(path), "sku string, price int, description string", name="raw_seed")
    assert [tuple(r) for r in spark.table("raw_seed").collect()] == [
        ("A-1", 1100, "one, two"),
        ("A-2", 5, 'say "hi"'),
    ]
    assert df.schema["price"].dataType.typeName() == "integer"


@pytest.mark.parametrize(
    ("kind", "url"),
    [
        ("SQLServer", "jdbc:sqlserver://db:1433;databaseName=shop;encrypt=true;trustServerCertificate=false;"),
        ("postgresql", "jdbc:postgresql://db:5432/shop"),
        ("mysql", "jdbc:mysql://db:3306/shop?useSSL=false"),
        ("mariadb", "jdbc:mariadb://db:3306/shop"),
    ],
)
def test_jdbc_options(kind, url):
    options = jdbc.jdbc_options(kind, "db", "shop", "s.t", "me", "secret")
    assert options["url"] == url
    assert "partitionColumn" not in options
    part = jdbc.JdbcPartition("id", 1, 1000, 16)
    options = jdbc.jdbc_options(kind, "db", "shop", "s.t", "me", "secret", part, port=99)
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("id", "16", "1000")
    assert ":99" in options["url"]


def test_unknown_database_is_refused():
    with pytest.raises(ValueError, match="unsupported"):
        jdbc.jdbc_options("oracle", "db", "shop", "t", "u", "p")


def test_plan_save_and_load(spark, tmp_path):
    rows = [("Completitud", "col a", "t", "s", None), ("Precision", "c", "t", "s", "2"), ("Exactitud", 'q"x', "t", "s", None)]
    plan = spark.createDataFrame(rows, "tipo string, columna string, tabla string, schema string, num_decimales string")
    path = str(tmp_path / "plan")
    plan_files.save_plan(plan, path)
    text = next(p for p in os.listdir(path) if p.startswith("part"))
    with open(os.path.join(path, text), encoding="utf-8") as f:
        parsed = json.load(f)
    assert [t["tipo"] for t in parsed] == ["Completitud", "Precision", "Exactitud"]
    loaded = plan_files.load_plan(spark, path)
    assert loaded.columns == list(plan_files.PLAN_FIELDS)
    assert {(r["columna"], r["num_decimales"]) for r in loaded.collect()} == {("col a", None), ("c", "2"), ('q"x', None)}


@pytest.mark.parametrize("text", ['{"tipo": "Completitud"}', '[1, 2]', '["a"]', "nothing", '[{"tipo": "x"}, 3]'])
def test_plan_of_another_form_is_rejected(spark, tmp_path, text):
    path = tmp_path / "plan.json"
    path.write_text(text)
    with pytest.raises(plan_files.PlanFormatError):
        plan_files.load_plan(spark, str(path))


def test_empty_plan_is_a_plan(spark, tmp_path):
    path = tmp_path / "plan.json"
    path.write_text("[]")
    assert plan_files.load_plan(spark, str(path)).count() == 0


def result_rows(stamp, **percents):
    return [
        {results.INDICATOR: name, results.VALUE: p / 100, results.PERCENT: f"{p}%", results.STAMP: stamp}
        for name, p in percents.items()
    ]


def test_history_of_array_files(spark, tmp_path):
    first = result_rows("2024-11-05_07:08", A=10, B=20)
    second = result_rows("2024-12-06_18:30", A=15) + result_rows("2024-12-06_18:31", B=20)
    bad = [{k: v for k, v in r.items() if k != results.PERCENT} for r in first]
    for name, rows in (("r1", first), ("r2", second), ("r3", bad)):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, ensure_ascii=False, indent=2), encoding="utf-8")
    (tmp_path / "r4.json").write_text("not json", encoding="utf-8")
    paths = [str(tmp_path / f"r{i}.json") for i in (1, 2, 3, 4)]
    rejected = [r["file"] for r in results.rejected_files(spark, paths, legacy=True).collect()]
    assert sorted(f[-7:] for f in rejected) == ["r3.json", "r4.json"]
    history = results.load_history(spark, paths, legacy=True)
    rows = {(r["indicator"], r["evaluation"]): (r["percent"], r["change"]) for r in evolution(history).collect()}
    # Every row of a file carries the stamp of the file's first row.
    assert rows == {
        ("A", "2024-11-05_07:08"): (10, None),
        ("B", "2024-11-05_07:08"): (20, None),
        ("A", "2024-12-06_18:30"): (15, 5),
        ("B", "2024-12-06_18:30"): (20, 0),
    }
    wide = {r["indicator"]: r["2024-12-06_18:30"] for r in evolution_table(history).collect()}
    assert wide == {"A": 15, "B": 20}


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_saving_a_run_twice_leaves_no_duplicates(spark, tmp_path, fmt):
    path = str(tmp_path / "history")
    for stamp, percent in (("2025-01-01_08:00", 40), ("2025-02-01_08:00", 50), ("2025-02-01_08:00", 50)):
        df = spark.createDataFrame(
            [tuple(r.values()) for r in result_rows(stamp, A=percent)], results.RESULT_SCHEMA
        )
        results.save_results(df, path, stamp, fmt)
    history = results.load_history(spark, path, fmt=fmt)
    rows = sorted((r["evaluation"], r["percent"], r["change"]) for r in evolution(history).collect())
    assert rows == [("2025-01-01_08:00", 40, None), ("2025-02-01_08:00", 50, 10)]
    both = union_history([history, history.drop(results.VALUE)])
    assert both.count() == 4 and both.filter(f"`{results.VALUE}` IS NULL").count() == 2


def test_materialize(spark, boats, tmp_path):
    assert tables.materialize(boats.select("boat_id"), "m_view", "view").count() == 7
    path = str(tmp_path / "m_table")
    table = tables.materialize(boats, "m_table", "table", path=path, cluster_by=["boat_id"], buckets=4)
    assert table.count() == 7
    plan = table.groupBy("boat_id").agg(F.count("*")).select("boat_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert tables.materialize(boats.limit(3), "m_plain", "table").count() == 3
    with pytest.raises(ValueError):
        tables.materialize(boats, "x", "cube")


def test_scratch_uses_the_named_folder(spark):
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch.scratch_path(spark, "x")
