"""A partitioned table whose partitions are switched by pointer.

Every write puts whole new partition folders under a folder of its own and then
commits a manifest that maps each partition to its folder. Nothing that a
version refers to is ever overwritten, so a writer that dies at any step leaves
the version before it whole, a reader sees one version or the next and may stay
on the one it opened, and a rerun starts from what is in force.

The manifest also holds the schema, so opening a version reads no file footer.
"""

from __future__ import annotations

import dataclasses
import urllib.parse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.serving import upsert as upsert_rows
from . import manifest as M
from . import tables

#: Versions whose folders stay for readers that opened them.
KEEP_VERSIONS = 5
#: Bytes of a row group in tables with a lookup column: what a keyed read reads at least.
ROW_GROUP_BYTES = 8 << 20
_WRITE = "_write"
_PROPERTY = "viewlog.version"


@dataclasses.dataclass(frozen=True)
class Version:
    number: int  # 0: nothing committed yet
    schema: T.StructType  # data columns, then the partition column
    partitions: dict[str, str]  # folder name, column=value as Spark writes it -> path below the root


class VersionedTable:
    """The table under ``root``, one folder per value of ``partition_col``.

    ``lookup`` names a column that single rows are looked up by: each partition
    is written in ranges of it, sorted, with a Bloom filter per row group, so a
    read of one key skips the files and row groups that cannot hold it.
    """

    def __init__(self, spark: SparkSession, root: str, partition_col: str, lookup: str | None = None) -> None:
        self.spark, self.root, self.partition_col, self.lookup = spark, root.rstrip("/"), partition_col, lookup

    # --- reading ---

    def version(self, number: int | None = None) -> Version | None:
        """The version in force (or the given one); None if nothing was written."""
        found = M.load(self.spark, self.root, number)
        if found is not None:
            n, content = found
            return Version(n, T.StructType.fromJson(content["schema"]), content["partitions"])
        return self._adopted()

    def _adopted(self) -> Version | None:
        """Partition folders that lie under the root without a manifest, as plain partitioned writes leave them."""
        p, fs = M._path(self.spark, self.root)
        if not fs.exists(p):
            return None
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        parts = {n: n for n in names if n.startswith(f"{self.partition_col}=")}
        if not parts:
            return None
        schema = self.spark.read.option("mergeSchema", "true").parquet(self.root).schema
        data = [f for f in schema.fields if f.name != self.partition_col]
        return Version(0, T.StructType([*data, T.StructField(self.partition_col, T.StringType())]), parts)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version; filters on the partition column prune its folders."""
        v = self.version(number)
        if v is None:
            raise FileNotFoundError(f"nothing was written to {self.root}")
        return self.rows(v, v.partitions)

    def rows(self, v: Version, partitions: dict[str, str]) -> DataFrame:
        """The rows of some partitions of a version."""
        if not partitions:
            return self.spark.createDataFrame([], v.schema)
        schema = T.StructType([*v.schema.fields, T.StructField(_WRITE, T.StringType())])
        paths = [f"{self.root}/{partitions[k]}" for k in sorted(partitions)]
        # Adopted folders have no folder of a write above them, so the two kinds are read apart.
        out = None
        for written in (True, False):
            some = [p for k, p in zip(sorted(partitions), paths, strict=True) if partitions[k].startswith(f"{_WRITE}=") == written]
            if some:
                part = self.spark.read.schema(schema if written else v.schema).option("basePath", self.root).parquet(*some)
                part = part.select(*[F.col(tables.quote(f.name)) for f in v.schema.fields])
                out = part if out is None else out.unionByName(part)
        return out

    # --- writing ---

    def upsert(self, updates: DataFrame, keys: Sequence[str], keep: int = KEEP_VERSIONS) -> int:
        """``INSERT ... ON DUPLICATE KEY UPDATE``: the number of the new version.

        The updates are evaluated and written once, as the folders of a new
        version. Only partitions of the old one that they touch are read, merged
        with the folders just written, and written anew; columns the table lacks
        are added (see ``tables.routed``), and those the updates lack are NULL.
        """
        old = self.version()
        data = [f for f in updates.schema.fields if f.name != self.partition_col]
        schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in (*data, updates.schema[self.partition_col])])
        if old is not None:
            schema = evolved(old.schema, updates)
            updates = tables.routed(schema, updates)
        written = self._write(_aligned(updates, schema))
        touched = {} if old is None else self._touched(written, old)
        if touched:
            values = {self._value(n) for n in touched}
            fresh = Version(0, schema, {n: p for n, p in written.items() if self._value(n) in values})
            rows = upsert_rows(_aligned(self.rows(old, touched), schema), self.rows(fresh, fresh.partitions), keys)
            written |= self._write(rows)
        number = self._commit(written, schema, old, list(touched))
        self.vacuum(keep)
        return number

    def replace(self, rows: DataFrame, partitions: Sequence[str], keep: int = KEEP_VERSIONS) -> int:
        """Put ``rows`` in place of the named partitions (folder names); those that get no row go."""
        old = self.version()
        schema = T.StructType([*[f for f in rows.schema.fields if f.name != self.partition_col], rows.schema[self.partition_col]])
        if old is not None:
            schema = evolved(old.schema, rows)
            rows = tables.routed(schema, rows)
        number = self._switch(_aligned(rows, schema), schema, old, partitions)
        self.vacuum(keep)
        return number

    def _switch(self, rows: DataFrame, schema: T.StructType, old: Version | None, gone: Sequence[str]) -> int:
        """Write the partitions of ``rows`` and commit a version that has them, the old ones, and none of ``gone``."""
        return self._commit(self._write(rows), schema, old, gone)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write the partitions of ``rows`` to folders of their own, which no version has yet."""
        write = f"{_WRITE}={uuid.uuid4().hex}"
        writer = rows.write
        if self.lookup is not None:
            order = [F.col(tables.quote(c)) for c in (self.partition_col, self.lookup)]
            # Ranges are cut by sampled rows, so a large partition is spread over many files.
            writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.lookup}", "true").option("parquet.block.size", str(ROW_GROUP_BYTES))
        writer.partitionBy(self.partition_col).parquet(f"{self.root}/{write}")
        return {n: f"{write}/{n}" for n in self._folders(write)}

    def _commit(self, written: dict[str, str], schema: T.StructType, old: Version | None, gone: Sequence[str]) -> int:
        kept = {n: p for n, p in (old.partitions if old else {}).items() if n not in set(gone)}
        number = (old.number if old else 0) + 1
        return M.commit(self.spark, self.root, number, {"schema": schema.jsonValue(), "partitions": {**kept, **written}})

    def _touched(self, written: dict[str, str], old: Version) -> dict[str, str]:
        """The old partitions whose value of the partition column is among those just written."""
        values = {self._value(n) for n in written}
        return {n: p for n, p in old.partitions.items() if self._value(n) in values}

    def _folders(self, write: str) -> list[str]:
        p, fs = M._path(self.spark, f"{self.root}/{write}")
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        return [n for n in names if n.startswith(f"{self.partition_col}=")]

    def vacuum(self, keep: int = KEEP_VERSIONS) -> None:
        """Delete versions before the last ``keep``, and the folders that only they use.

        Folders of writers that died before their commit go too, once a later
        version is in force, so only one writer may be at work on a table.
        """
        have = M.versions(self.spark, self.root)
        if not have:
            return
        kept = [M.load(self.spark, self.root, v)[1] for v in have[-keep:]]
        used = {path for m in kept for path in m["partitions"].values()}
        p, fs = M._path(self.spark, self.root)
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("_stage-"):
                fs.delete(st.getPath(), True)
            elif name.startswith(f"{_WRITE}="):
                inner = [f"{name}/{x.getPath().getName()}" for x in fs.listStatus(st.getPath()) if x.isDirectory()]
                if not used.intersection(inner):
                    fs.delete(st.getPath(), True)
                else:
                    for path in set(inner) - used:
                        tables.delete_path(self.spark, f"{self.root}/{path}")
        M.forget(self.spark, self.root, have[:-keep])

    # --- the catalog ---

    def register(self, table: str) -> None:
        """Let the catalog's ``table`` show the version in force: its columns, and the folder of each partition."""
        v = self.version()
        if v is None:
            return
        spark = self.spark
        if not tables.table_exists(spark, table):
            tables.create_table(spark, table, v.schema, [self.partition_col], self.root)
        have = {c.lower() for c in tables.columns_of(spark, table)}
        new = [f for f in v.schema.fields if f.name.lower() not in have]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(map(tables._column_ddl, new))})")
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        add = [n for n in v.partitions if n not in known]
        if add:
            clauses = " ".join(f"PARTITION ({self._spec(n)}) LOCATION '{self.root}/{v.partitions[n]}'" for n in add)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
        before = self._shown(table)
        for n in known & set(v.partitions):
            if before.get(n) != v.partitions[n]:
                spark.sql(f"ALTER TABLE {table} PARTITION ({self._spec(n)}) SET LOCATION '{self.root}/{v.partitions[n]}'")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PROPERTY}' = '{v.number}')")
        spark.catalog.refreshTable(table)

    def _shown(self, table: str) -> dict[str, str]:
        """The folders of the version that the catalog's table shows, if that is still known."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _PROPERTY).first()
        if found is None or int(found["value"]) not in M.versions(self.spark, self.root):
            return {}
        return M.load(self.spark, self.root, int(found["value"]))[1]["partitions"]

    def _value(self, name: str) -> str | None:
        """The value that a partition folder's name stands for."""
        value = name.split("=", 1)[1]
        return None if value == "__HIVE_DEFAULT_PARTITION__" else urllib.parse.unquote(value)

    def _spec(self, name: str) -> str:
        value = self._value(name)
        text = "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{tables.quote(self.partition_col)}={text}"


def evolved(schema: T.StructType, df: DataFrame) -> T.StructType:
    """``schema`` with the columns that ``df`` adds, siblings marked as such; the partition column stays last."""
    moved = tables.routed(schema, df)
    made_for = tables._siblings(schema, df, moved)
    have = {f.name.lower() for f in schema.fields}
    new = [
        T.StructField(f.name, f.dataType, metadata=tables._marked(f, made_for))
        for f in moved.schema.fields
        if f.name.lower() not in have
    ]
    return T.StructType([*schema.fields[:-1], *new, schema.fields[-1]])


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[(F.col(tables.quote(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
