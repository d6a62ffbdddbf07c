"""Relational serving target over JDBC (K7, K8, K9).

The export writes the aligned snapshot to a staging table with Spark's JDBC
writer (parallel connections, batched inserts), then merges the staging table
into the keyed target inside the database, then drops the staging table.
The merge statement is standard SQL ``MERGE``; the MySQL form the original
uses (``INSERT ... ON DUPLICATE KEY UPDATE``) is available as a dialect.

Not exercised against a live database in this repository: the only databases
available here would be private to one process (see README).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DIALECTS = ("ansi", "mysql")


@dataclasses.dataclass(frozen=True)
class JdbcTarget:
    """A keyed table of a relational database."""

    url: str
    table: str
    props: dict[str, str] = dataclasses.field(default_factory=dict)
    dialect: str = "ansi"
    batch_size: int = 50_000
    partitions: int = 4

    def __post_init__(self) -> None:
        if self.dialect not in DIALECTS:
            raise ValueError(f"dialect is one of {', '.join(DIALECTS)}, not {self.dialect!r}")

    def schema(self, spark: SparkSession) -> T.StructType:
        """The table's own columns and types, from the database's metadata; no row is read."""
        reader = spark.read.format("jdbc").option("url", self.url).option("dbtable", self.table)
        for k, v in self.props.items():
            reader = reader.option(k, v)
        return reader.load().schema

    def upsert(self, spark: SparkSession, rows: DataFrame, keys: Sequence[str]) -> None:
        """Rows in the table's layout go in by key, through a staging table."""
        upsert_via_staging(spark, rows, self.url, self.table, keys, self.props, self.dialect, self.batch_size, self.partitions)


def write_staging(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None,
                  batch_size: int = 50_000, partitions: int = 4) -> None:
    """K7: overwrite ``table`` with ``df`` through ``partitions`` connections."""
    w = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
        .option("numPartitions", str(partitions))
        .mode("overwrite")
    )
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()


def merge_sql(target: str, staging: str, columns: Sequence[str], keys: Sequence[str],
              dialect: str = "ansi") -> str:
    """K8: the statement that upserts ``staging`` into ``target``."""
    mark = "`" if dialect == "mysql" else '"'

    def name(c: str) -> str:
        return mark + c.replace(mark, mark * 2) + mark

    cols = [name(c) for c in columns]
    rest = [name(c) for c in columns if c not in keys]
    if dialect == "mysql":
        upd = ", ".join(f"{c} = new.{c}" for c in rest) or f"{cols[0]} = new.{cols[0]}"
        listed = ", ".join(cols)
        return (f"INSERT INTO {target} ({listed}) SELECT {listed} FROM (SELECT {listed} FROM {staging}) AS new "
                f"ON DUPLICATE KEY UPDATE {upd}")
    # Null-safe, as the table path matches keys.
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in map(name, keys))
    upd = ", ".join(f"{c} = s.{c}" for c in rest)
    ins = ", ".join(f"s.{c}" for c in cols)
    return (f"MERGE INTO {target} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {upd} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) VALUES ({ins})")


def execute(spark: SparkSession, url: str, statements: Sequence[str], props: dict[str, str] | None = None) -> None:
    """Run statements on the database from the driver, in one transaction,
    through the JVM's JDBC driver manager (the driver class must be on the
    classpath, as for the writer)."""
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for k, v in (props or {}).items():
        info.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def upsert_via_staging(spark: SparkSession, df: DataFrame, url: str, target: str, keys: Sequence[str],
                       props: dict[str, str] | None = None, dialect: str = "ansi",
                       batch_size: int = 50_000, partitions: int = 4) -> None:
    """K7 -> K8 -> K9: stage, merge, and always drop the staging table."""
    staging = f"{target}_staging"
    try:
        write_staging(df, url, staging, props, batch_size, partitions)
        execute(spark, url, [merge_sql(target, staging, df.columns, keys, dialect)], props)
    finally:
        execute(spark, url, [f"DROP TABLE IF EXISTS {staging}"], props)
