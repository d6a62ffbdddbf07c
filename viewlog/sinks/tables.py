"""Catalog tables: namespace, create, align, evolve, append, partition
overwrite, keyed upsert, drop (K1-K6, K8, K9, S7, S8; Q6, Q7, Q9).

Tables are Parquet data-source tables in the session catalog. Writes go by
column name: every write is aligned to the table's current column order
first, because ``insertInto`` is positional and evolved columns land before
the partition columns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.serving import upsert as upsert_rows
from . import manifest as M


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A row count that rides on the next action (the write), so
    feedback costs no extra job. Read it with ``obs.get["rows"]`` afterwards."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """O2: the first ``n`` rows (``limit``; a CollectLimit, not a full job)."""
    return df.limit(n)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Start of the comment of a sibling column; the name it was made for follows.
ORIGIN = "sibling of "


def origin_of(column: T.StructField) -> str | None:
    """The (lower-case) name a sibling column was made for; None for other columns."""
    comment = column.metadata.get("comment", "")
    return comment[len(ORIGIN):] if comment.startswith(ORIGIN) else None


#: Start of the comment of a column that holds a JSON key not called like it; the key's path follows.
KEY = "key "
#: Metadata entry with that path on the way to a new column.
KEY_METADATA = "json_path"


def key_path(path: Sequence[str]) -> str:
    """A JSON key's path as text: the key itself, or a JSON list of nested ones."""
    return path[0] if len(path) == 1 and not path[0].startswith("[") else json.dumps(list(path), ensure_ascii=False)


def key_of(column: T.StructField) -> str:
    """The path of the JSON key that a column holds; its name where no comment tells another."""
    comment = column.metadata.get("comment", "")
    return comment[len(KEY):] if comment.startswith(KEY) else column.name


def free_name(name: str, taken: set[str]) -> str:
    """``name``, or the first of ``name_2``, ``name_3``, ... not taken (in lower case)."""
    k, out = 2, name
    while out.lower() in taken:
        out, k = f"{name}_{k}", k + 1
    return out


def _column_ddl(f: T.StructField) -> str:
    comment = f.metadata.get("comment")
    text = comment.replace("\\", "\\\\").replace("'", "\\'") if comment else ""
    return f"{quote(f.name)} {f.dataType.simpleString()}" + (f" COMMENT '{text}'" if comment else "")


def create_namespace(spark: SparkSession, ns: str, location: str | None = None) -> None:
    """K1 (with an explicit location on shared storage when given)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}{loc}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def columns_of(spark: SparkSession, table: str) -> list[str]:
    """Ordered column names of a table."""
    return [f.name for f in spark.table(table).schema.fields]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


#: Folder of the schema register below a table's location.
SCHEMA_FOLDER = "_schema"


def location_of(spark: SparkSession, table: str) -> str | None:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").first()
    return found["data_type"] if found else None


def registered_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The newest schema of the register beside a table's files."""
    found = M.load(spark, location, folder=SCHEMA_FOLDER)
    if found is None:
        return None
    return T.StructType([
        T.StructField(c["name"], T._parse_datatype_string(c["type"]), metadata={"comment": c["comment"]} if c["comment"] else {})
        for c in found[1]["columns"]
    ])


def record_schema(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Put the table's columns into the register: name, JSON key, type and comment, one version per change.

    Called before a new column is written, so the register is never behind the
    files. Columns that another writer recorded meanwhile stay.
    """
    location = location or location_of(spark, table)
    if location is None:
        return
    for _ in range(10):
        found = M.load(spark, location, folder=SCHEMA_FOLDER)
        old = found[1]["columns"] if found else []
        schema = spark.table(table).schema
        mine = [{"name": f.name, "key": key_of(f), "type": f.dataType.simpleString(), "comment": f.metadata.get("comment")} for f in schema.fields]
        names = {c["name"].lower() for c in mine}
        columns = [*mine, *(c for c in old if c["name"].lower() not in names)]
        if found and {json.dumps(c, sort_keys=True) for c in columns} == {json.dumps(c, sort_keys=True) for c in old}:
            return
        try:
            M.commit(spark, location, (found[0] if found else 0) + 1, {"columns": columns}, folder=SCHEMA_FOLDER)
            return
        except M.VersionTaken:
            continue
    raise RuntimeError(f"the schema register of {table} kept changing")


def create_table(spark: SparkSession, table: str, schema: T.StructType, partitioned_by: Sequence[str] = (),
                 location: str | None = None) -> None:
    """K2: typed DDL, ``PARTITIONED BY``, optional ``LOCATION``."""
    cols = ", ".join(map(_column_ddl, schema.fields))
    part = f" PARTITIONED BY ({', '.join(quote(c) for c in partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part}{loc}")
    if location:
        record_schema(spark, table, location)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staging directory this code created (recursive)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def list_partition_values(spark: SparkSession, root: str, col: str) -> list[str]:
    """Values of ``col=<value>`` directories directly under ``root``, from
    the file-system listing (metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(col + "="):
            out.append(jvm.org.apache.hadoop.fs.Path(name).getName().split("=", 1)[1])
    return sorted(out)


def _has_files(spark: SparkSession, location: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(location)
    it = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    while it.hasNext():
        if not it.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def register_existing(spark: SparkSession, table: str, location: str, partitioned_by: Sequence[str] = ()) -> bool:
    """Put a table whose files already exist at ``location`` back into the
    catalog: its schema from the register beside them, so that no file is
    opened, its partitions from the folders. Used when the catalog does not
    outlive the process; a no-op if the table is known or the location holds
    nothing yet."""
    if table_exists(spark, table) or not path_exists(spark, location):
        return False
    schema = registered_schema(spark, location)
    if schema is None:
        if not _has_files(spark, location):
            return False
        # Files of before the register: their schemas merged, as evolved columns are in the later ones only.
        schema = spark.read.option("basePath", location).option("mergeSchema", "true").parquet(location).schema
    data = [f for f in schema.fields if f.name not in partitioned_by]
    parts = [schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in partitioned_by]
    create_table(spark, table, T.StructType(data + parts), partitioned_by, location)
    if partitioned_by:
        # The catalog tracks partitions: list them back from the directories.
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return True


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def fits(given: T.DataType, column: T.DataType) -> bool:
    """Whether every value of ``given`` can be stored as ``column`` unchanged."""
    a, b = given.simpleString(), column.simpleString()
    if a in (b, "void"):
        return True
    if a in _INTEGRAL and b in _INTEGRAL:
        return _INTEGRAL.index(a) <= _INTEGRAL.index(b)
    if b == "double":
        return a in ("float", "int", "smallint", "tinyint")
    return b == "string" and not isinstance(given, (T.StructType, T.ArrayType, T.MapType, T.BinaryType))


def routed(schema: T.StructType, df: DataFrame) -> DataFrame:
    """``df`` with every column that the table's column of its name cannot
    hold renamed to a sibling, so that no value is cut or lost.

    The sibling is the table's column made for this name and wide enough, else
    ``<name>_<type>`` under the first name (``_2``, ``_3``, ...) that neither
    the table nor ``df`` uses. Siblings carry the name they were made for in
    their comment, so a key of the data that is called like one never mixes
    with it.
    """
    have = {f.name.lower(): f for f in schema.fields}
    taken = set(have) | {c.lower() for c in df.columns}
    names = []
    for f in df.schema.fields:
        name = f.name
        column = have.get(name.lower())
        if column is not None and (origin_of(column) or not fits(f.dataType, column.dataType)):
            made_for = [c for c in schema.fields if origin_of(c) == name.lower() and fits(f.dataType, c.dataType)]
            kind = re.sub(r"\W+", "_", f.dataType.simpleString()).strip("_")
            same = next((c.name for c in made_for if c.dataType == f.dataType), None)
            name = same or (made_for[0].name if made_for else free_name(f"{f.name}_{kind}", taken))
            taken.add(name.lower())
        names.append(name)
    if names == df.columns:
        return df
    return df.select(*[F.col(quote(c)).alias(n) for c, n in zip(df.columns, names, strict=True)])


def _siblings(schema: T.StructType, df: DataFrame, moved: DataFrame) -> dict[str, str]:
    """New sibling columns of ``moved`` and the names they are made for."""
    have = {f.name.lower() for f in schema.fields}
    pairs = zip(df.columns, moved.columns, strict=True)
    return {n: c.lower() for c, n in pairs if n != c and n.lower() not in have}


def _marked(f: T.StructField, made_for: dict[str, str]) -> dict:
    """Metadata of a new column: a comment if it is a sibling, or holds a key that is not called like it."""
    if f.name in made_for:
        return {"comment": ORIGIN + made_for[f.name]}
    return {"comment": KEY + f.metadata[KEY_METADATA]} if KEY_METADATA in f.metadata else {}


def evolve(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """K5: add the columns ``df`` has and the table lacks, with their real
    types and quoted names (Q6). Old rows read NULL for them. A known column
    that comes with a type the table's cannot hold gets a sibling column."""
    schema = spark.table(table).schema
    moved = routed(schema, df)
    made_for = _siblings(schema, df, moved)
    have = {f.name.lower() for f in schema.fields}
    new = [f for f in moved.schema.fields if f.name.lower() not in have]
    if new:
        new = [T.StructField(f.name, f.dataType, metadata=_marked(f, made_for)) for f in new]
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(map(_column_ddl, new))})")
        record_schema(spark, table)
    return [f.name for f in new]


def align(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """Reorder ``df`` to the table's column order; absent columns are NULL.
    Names match without regard to case, as in ``evolve``."""
    schema = spark.table(table).schema
    df = routed(schema, df)
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[(F.col(quote(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in schema.fields]
    )


def append(spark: SparkSession, table: str, df: DataFrame, partitioned_by: Sequence[str] = (),
           location: str | None = None) -> None:
    """K3 + K5 + K4: create from the DataFrame if the table does not exist
    (decided by ``tableExists``, not by catching errors, Q9), otherwise add
    new columns and append by name."""
    if not table_exists(spark, table):
        if location:
            # DDL with an explicit LOCATION, so the data sits on the given
            # shared storage rather than in the catalog's warehouse.
            cols = [f for f in df.schema.fields if f.name not in partitioned_by]
            cols += [df.schema[c] for c in partitioned_by]
            create_table(spark, table, T.StructType(cols), partitioned_by, location)
            align(spark, table, df).write.insertInto(table)
            return
        w = df.writeTo(table).using("parquet")
        if partitioned_by:
            w = w.partitionedBy(*[F.col(c) for c in partitioned_by])
        w.create()
        return
    evolve(spark, table, df)
    align(spark, table, df).write.insertInto(table)


def overwrite_partitions(spark: SparkSession, table: str, df: DataFrame, partitioned_by: Sequence[str] = (),
                         location: str | None = None) -> None:
    """K6: replace exactly the partitions present in ``df`` (dynamic partition
    overwrite), so a rerun of the same day replaces that day (Q7)."""
    if not table_exists(spark, table):
        append(spark, table, df, partitioned_by, location)
        return
    evolve(spark, table, df)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    align(spark, table, df).write.insertInto(table, overwrite=True)


def upsert(spark: SparkSession, table: str, updates: DataFrame, keys: Sequence[str],
           partition_col: str | None = None, partitions: Sequence[str] | None = None) -> None:
    """K8 on a table target: ``INSERT ... ON DUPLICATE KEY UPDATE``.

    With a partition column in the key, only the partitions the updates
    touch are read and rewritten: their old rows minus the updated keys, plus
    the updates, go back by dynamic partition overwrite. Spark writes the new
    partition files to a staging directory and swaps them in at job commit,
    so the old rows are still readable while the job runs.
    """
    if not table_exists(spark, table):
        append(spark, table, updates, [partition_col] if partition_col else [])
        return
    evolve(spark, table, updates)
    target = spark.table(table)
    updates = align(spark, table, updates)
    if partition_col:
        # Listed partitions prune statically; else a semi-join restricts the
        # target. NULL is a partition like others: its old rows are read back
        # too, as the overwrite below replaces them.
        if partitions is not None:
            named = [p for p in partitions if p is not None]
            touched = F.col(partition_col).isin(named)
            if len(named) < len(partitions):
                touched = touched | F.col(partition_col).isNull()
            target = target.filter(touched)
        else:
            days = updates.select(F.col(partition_col).alias("_touched")).distinct()
            target = target.join(days, target[partition_col].eqNullSafe(days["_touched"]), "left_semi")
    merged = upsert_rows(target, updates, keys).select(*columns_of(spark, table))
    if partition_col:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        merged.write.insertInto(table, overwrite=True)
        return
    # A whole-table overwrite cannot read its own files while it runs: stage
    # the merged rows in shared storage, overwrite from there, then drop them.
    from ..session import scratch_path

    path = scratch_path(spark, "upsert-stage")
    merged.write.parquet(path)
    spark.read.parquet(path).write.insertInto(table, overwrite=True)
    delete_path(spark, path)


def drop_table(spark: SparkSession, table: str) -> None:
    """K9."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def latest_partition(spark: SparkSession, table: str, col: str) -> str | None:
    """Largest value of a partition column, from the catalog's partition
    list when available, so no data file is read."""
    try:
        rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    except Exception:  # noqa: BLE001 - not partitioned / listing unsupported
        rows = []
    vals = []
    for r in rows:
        for kv in r[0].split("/"):
            k, _, v = kv.partition("=")
            if k == col:
                vals.append(v)
    if vals:
        return max(vals)
    return spark.table(table).agg(F.max(col)).first()[0]
