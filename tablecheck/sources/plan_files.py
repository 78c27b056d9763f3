"""Quality plans as JSON files: one array of flat objects, all values text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a plan.
PLAN_FIELDS = (
    "tipo", "columna", "tabla", "schema", "patron", "tipo_exactitud", "tipo_credibilidad",
    "num_decimales", "columna_2", "tabla_2", "tiempo_limite", "tipo_actualidad",
)
PLAN_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in PLAN_FIELDS])


class PlanFormatError(ValueError):
    """The file is not a JSON array of objects."""


def load_plan(spark: SparkSession, path: str) -> DataFrame:
    """Read a plan; anything but an array of objects is rejected.

    A plan is a short configuration file, so its form is checked at once: the
    text must parse as an array, and every element as an object.
    """
    text = spark.read.text(path, wholetext=True)
    items = F.from_json("value", "array<string>")
    checked = text.select(
        F.ltrim(F.col("value")).startswith("[").alias("is_array"),
        F.forall(F.coalesce(items, F.array(F.lit(""))), lambda x: F.ltrim(x).startswith("{")).alias("all_objects"),
    )
    bad = checked.filter(~(F.col("is_array") & F.col("all_objects")))
    if bad.limit(1).count():
        raise PlanFormatError(f"not a list of tests: {path}")
    return spark.read.schema(PLAN_SCHEMA).option("multiline", True).json(path)


def save_plan(plan: DataFrame, path: str) -> None:
    """Write a plan as one pretty-printed JSON array that :func:`load_plan` reads.

    A plan is a few rows and must stay one array in its order, hence one file.
    """
    fields = [F.col(c) for c in PLAN_FIELDS if c in plan.columns]
    tests = plan.select(F.monotonically_increasing_id().alias("i"), F.struct(*fields).alias("test"))
    ordered = tests.agg(F.array_sort(F.collect_list(F.struct("i", "test"))).alias("tests"))
    array = F.to_json(F.col("tests.test"), {"pretty": "true"})
    ordered.select(array.alias("value")).coalesce(1).write.mode("overwrite").text(path)
