"""Result files of plan runs: save, load, reject malformed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a result.
INDICATOR = "Nombre de indicador"
VALUE = "Valor"
PERCENT = "Porcentaje"
STAMP = "Fecha y hora de ejecución"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField(INDICATOR, T.StringType()),
        T.StructField(VALUE, T.DoubleType()),
        T.StructField(PERCENT, T.StringType()),
        T.StructField(STAMP, T.StringType()),
    ]
)


def save_results(df: DataFrame, path: str, run_ts: str, fmt: str = "json") -> None:
    """Add a run to a result history, as JSON Lines or Parquet.

    Runs are partitions ``run_ts=...``; saving the same run again replaces it,
    so a repeated job leaves no duplicates.
    """
    (
        df.withColumn("run_ts", F.lit(run_ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts")
        .format(fmt)
        .save(path)
    )


def read_history(spark: SparkSession, paths: str | list[str], legacy: bool = False, fmt: str = "json") -> DataFrame:
    """All rows of a set of result files, with their file and position in it.

    ``legacy`` files are JSON arrays, ours are JSON Lines or Parquet.
    """
    reader = spark.read.schema(RESULT_SCHEMA).option("recursiveFileLookup", True)
    if legacy:
        reader = reader.option("multiline", True)
    df = reader.format(fmt).load(paths)
    position = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return df.select(
        *[F.col(f"`{c}`") for c in RESULT_SCHEMA.names],
        F.col("_metadata.file_path").alias("file"),
        position.alias("position"),
    )


def _file_checks(rows: DataFrame) -> DataFrame:
    """Per file: does it have the required columns, and the stamp of its first row."""
    required = [INDICATOR, PERCENT, STAMP]
    complete = F.lit(True)
    for c in required:
        complete = complete & (F.count(F.col(f"`{c}`")) > 0)
    return rows.groupBy("file").agg(
        complete.alias("complete"), F.min_by(F.col(f"`{STAMP}`"), "position").alias("evaluation")
    )


def load_history(
    spark: SparkSession, paths: str | list[str], legacy: bool = False, fmt: str = "json"
) -> DataFrame:
    """Rows of all well-formed result files, labelled by ``evaluation``: the stamp
    of the first row of their file. A file that lacks a required column is left
    out; :func:`rejected_files` lists those."""
    rows = read_history(spark, paths, legacy, fmt)
    good = _file_checks(rows).filter("complete").select("file", "evaluation")
    return rows.join(good, "file").drop("position")


def rejected_files(
    spark: SparkSession, paths: str | list[str], legacy: bool = False, fmt: str = "json"
) -> DataFrame:
    """Result files that lack the indicator, the percentage or the stamp."""
    return _file_checks(read_history(spark, paths, legacy, fmt)).filter("NOT complete").select("file")
