"""JDBC table scans for the four supported database kinds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Driver class, default port and URL form per database kind.
DIALECTS = {
    "sqlserver": (
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        1433,
        "jdbc:sqlserver://{host}:{port};databaseName={database};encrypt={encrypt};trustServerCertificate={trust};",
    ),
    "postgresql": ("org.postgresql.Driver", 5432, "jdbc:postgresql://{host}:{port}/{database}"),
    "mysql": ("com.mysql.cj.jdbc.Driver", 3306, "jdbc:mysql://{host}:{port}/{database}?useSSL=false"),
    "mariadb": ("org.mariadb.jdbc.Driver", 3306, "jdbc:mariadb://{host}:{port}/{database}"),
}


@dataclass(frozen=True)
class JdbcPartition:
    """Parallel read: ``partitions`` connections over ranges of a numeric, date
    or timestamp column. The bounds only place the cuts; no row is left out."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def jdbc_options(
    dialect: str,
    host: str,
    database: str,
    table: str,
    user: str,
    password: str,
    partition: JdbcPartition | None = None,
    port: int | None = None,
    fetch_size: int = 10_000,
    encrypt: bool = True,
    trust_certificate: bool = False,
) -> dict[str, str]:
    """Reader options of a table scan; an unknown database kind is refused.

    ``encrypt`` and ``trust_certificate`` apply to SQL Server; they are secure unless set otherwise.
    """
    kind = dialect.lower()
    if kind not in DIALECTS:
        raise ValueError(f"unsupported database kind: {dialect}")
    driver, default_port, form = DIALECTS[kind]
    options = {
        "url": form.format(
            host=host,
            port=port or default_port,
            database=database,
            encrypt=str(encrypt).lower(),
            trust=str(trust_certificate).lower(),
        ),
        "driver": driver,
        "dbtable": table,
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
    }
    if partition is not None:
        options |= {
            "partitionColumn": partition.column,
            "lowerBound": str(partition.lower),
            "upperBound": str(partition.upper),
            "numPartitions": str(partition.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    dialect: str,
    host: str,
    database: str,
    table: str,
    user: str,
    password: str,
    partition: JdbcPartition | None = None,
    port: int | None = None,
    **options,
) -> DataFrame:
    """Scan a database table; columns and filters used later are pushed into it.

    Without ``partition`` the table comes through one connection, which suits
    small tables only. Further ``options`` are those of :func:`jdbc_options`.
    """
    found = jdbc_options(dialect, host, database, table, user, password, partition, port, **options)
    return spark.read.format("jdbc").options(**found).load()
