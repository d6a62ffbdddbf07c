"""JSON-lines log source.

* ``indexed_lines``: every non-blank line with its 0-based offset inside its
  logical file, computed without moving rows through one task: a first pass
  counts lines per input split, a running sum over each file's splits gives
  every split its base offset, and a join on the split adds ``base + position``.
* ``discover_source_schema``: the payload struct type, declared fields first,
  keys the declaration does not know appended with types inferred from the
  data (one partial aggregate over the lines, no full-file inference read).
* ``parse_records`` / ``flatten``: ``from_json`` in PERMISSIVE mode (a
  malformed line keeps its text in ``_corrupt_record``) and a recursive
  struct flatten, nested keys joined with ``_``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import schemas
from ..sinks.tables import KEY_METADATA, free_name, key_of, key_path, origin_of, quote

CORRUPT = "_corrupt_record"
PATH = "_path"
BLOCK = "_block"
MID = "_mid"
FSIZE = "_fsize"
FTIME = "_fmtime"


# A source file's name is its file name without these suffixes
# (20220403.json -> 20220403, 20220403.jsonl.gz -> 20220403).
NAME_SUFFIX = r"(\.jsonl?)?(\.gz|\.bz2|\.zst|\.deflate)?$"


def name_from_file(col: str = "_metadata.file_name") -> Column:
    """Source file name from a file name; ``_metadata`` spells names
    URI-encoded, so percent-escapes are decoded (a literal ``+`` is kept)."""
    decoded = F.url_decode(F.replace(F.col(col), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, NAME_SUFFIX, "")


def read_lines(spark: SparkSession, path: str | list[str], base_path: str | None = None,
               file_name_col: str | None = None) -> DataFrame:
    """Non-blank lines of text files (blank lines hold no offset), with the
    file path and split start of each line. ``base_path`` turns
    ``key=value`` directories into columns (e.g. ``source_file``);
    ``file_name_col`` instead names each line's logical file after its file
    (one file per source file, as the original's daily objects)."""
    r = spark.read
    if base_path:
        r = r.option("basePath", base_path)
    raw = r.text(path)
    if file_name_col:
        raw = raw.withColumn(file_name_col, name_from_file())
    return with_position(raw)


ONE_FILE = "*"


def _file_keys(file_col: str | None) -> list[str]:
    """Columns that name a logical file beside its path."""
    return [file_col] if file_col and file_col != ONE_FILE else []


def _split_summary(lines: DataFrame, file_col: str | None) -> DataFrame:
    """One row per input split, with the lines of its logical file before it.

    Lines are summed within each path first, then over the paths of a logical
    file, so a running sum only spans the splits of one path, or the paths of
    one file.
    """
    keys = _file_keys(file_col)
    summ = lines.groupBy(*keys, PATH, BLOCK).agg(
        F.min(MID).alias("_min"), F.count(F.lit(1)).alias("_cnt"), F.max(FSIZE).alias(FSIZE),
        F.max(FTIME).alias(FTIME),
    )
    w = Window.partitionBy(*keys, PATH).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_base", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    if not file_col:
        return summ
    paths = summ.groupBy(*keys, PATH).agg(F.sum("_cnt").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(PATH).rowsBetween(Window.unboundedPreceding, -1)
    paths = paths.select(*keys, PATH, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return summ.join(paths, [*keys, PATH]).withColumn("_base", F.col("_base") + F.col("_before")).drop("_before")


def indexed_lines_with_files(spark: SparkSession, path: str | list[str], base_path: str | None = None,
                             file_col: str | None = None) -> tuple[DataFrame, list[str]]:
    """``indexed_lines`` plus the logical file names seen (from the split
    summary, so no extra pass)."""
    return index_lines(spark, read_lines(spark, path, base_path), file_col)


def with_position(lines: DataFrame, with_id: bool = True) -> DataFrame:
    """Non-blank lines of a text DataFrame (``value`` plus any other columns)
    with file path, split start and (unless ``with_id`` is off, as streams
    require) the position id, as ``read_lines`` gives."""
    keep = [c for c in lines.columns if c != "value"]
    out = lines.filter(F.length(F.trim(F.col("value"))) > 0).select(
        "value",
        *keep,
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_size").alias(FSIZE),
        F.col("_metadata.file_modification_time").alias(FTIME),
    )
    return out.withColumn(MID, F.monotonically_increasing_id()) if with_id else out


def index_lines(spark: SparkSession, lines: DataFrame, file_col: str | None = None) -> tuple[DataFrame, list[str]]:
    """Add ``row_index`` to positioned lines (see ``indexed_lines``)."""
    out, names, _ = index_lines_with_stats(spark, lines, file_col)
    return out, names


def index_lines_with_stats(spark: SparkSession, lines: DataFrame, file_col: str | None = None
                           ) -> tuple[DataFrame, list[str], dict[str, tuple[int, object]]]:
    """``index_lines`` plus, per logical file, (total bytes, latest mtime,
    non-blank lines) of its parts, from the same split summary (one row per
    logical file reaches the driver)."""
    keys = _file_keys(file_col)
    summ = _split_summary(lines, file_col)
    name = keys[0] if keys else PATH
    parts = summ.groupBy(*keys, PATH).agg(F.max(FSIZE).alias("s"), F.max(FTIME).alias("t"), F.sum("_cnt").alias("n"))
    per_file = parts.groupBy(F.col(name).alias("_name")).agg(F.sum("s"), F.max("t"), F.sum("n"))
    stats = {r[0]: (r[1], r[2], r[3]) for r in per_file.collect()}
    on = [*keys, PATH, BLOCK]
    out = lines.join(summ.drop(FSIZE, FTIME, "_cnt"), on, "inner")
    idx = (F.col("_base") + F.col(MID) - F.col("_min")).cast("bigint").alias(C.ROW_INDEX)
    keep = [c for c in lines.columns if c not in (PATH, BLOCK, MID, FSIZE, FTIME)]
    return out.select(*keep, idx), sorted(stats), stats


def indexed_lines(spark: SparkSession, path: str | list[str], base_path: str | None = None,
                  file_col: str | None = None) -> DataFrame:
    """Lines with ``row_index``: the 0-based offset inside the logical file.

    A logical file is one path, or, with ``file_col`` (a partition column
    such as ``source_file``), every path sharing that value, ordered by path;
    ``file_col=ONE_FILE`` makes the whole input one logical file (a directory
    of part files read in name order).
    Offsets are stable as long as the files do not change: both passes read
    the same splits.
    """
    return indexed_lines_with_files(spark, path, base_path, file_col)[0]


def slice_rows(lines: DataFrame, offset: int | Column, n: int | Column) -> DataFrame:
    """Rows ``[offset, offset + n)`` of each file (S2); short or empty past EOF."""
    o = F.lit(offset) if isinstance(offset, int) else offset
    k = F.lit(n) if isinstance(n, int) else n
    return lines.filter((F.col(C.ROW_INDEX) >= o) & (F.col(C.ROW_INDEX) < o + k))


# Where a type stands, not a key of the same name: at the start, after a key's
# colon, or as an array's element.
_TYPE_AT = r"(?:^|(?<=: )|(?<=ARRAY<))"
_VARIANT_FIXES = (
    (re.compile(_TYPE_AT + r"OBJECT<"), "STRUCT<"),
    (re.compile(_TYPE_AT + r"DECIMAL\(\d+,\s*\d+\)(?=[,>]|$)"), "DOUBLE"),
    (re.compile(_TYPE_AT + r"(?:VOID|VARIANT)(?=[,>]|$)"), "STRING"),
)


def _variant_type(spark: SparkSession, s: str) -> T.DataType:
    for pat, rep in _VARIANT_FIXES:
        s = pat.sub(rep, s)
    return T._parse_datatype_string(s)  # Spark's DDL type parser


def discover_source_schema(spark: SparkSession, lines: DataFrame, declared: T.StructType = schemas.SOURCE_FIELDS,
                           payload: str = "_source") -> T.StructType:
    """Declared payload fields plus every other key seen in ``lines``.

    ``schema_of_variant_agg`` merges the per-line JSON types in a partial
    aggregate, so only a type string reaches the driver. Declared fields keep
    their declared types; nested objects become structs; decimals read as
    DOUBLE; a key seen only with nulls reads as STRING.
    """
    body = F.get_json_object(F.col("value"), f"$.{payload}")
    agg = lines.select(F.schema_of_variant_agg(F.try_parse_json(body)).alias("s")).first()
    found = agg["s"] if agg else None
    fields = list(declared.fields)
    if found and found.startswith("OBJECT<"):
        inferred = _variant_type(spark, found)
        exact = {f.name for f in declared.fields}
        names = {f.name.lower() for f in fields}
        for f in inferred.fields:
            if f.name in exact:
                continue
            if f.name.lower() in names:
                # Differs from another key in case only: a text column with a name of its own.
                f = T.StructField(free_name(f.name, names), T.StringType(), metadata={KEY: f.name})
            names.add(f.name.lower())
            fields.append(f)
    return T.StructType(fields)


KEY = "json_key"


def parse_records(lines: DataFrame, payload_schema: T.StructType, payload: str = "_source") -> DataFrame:
    """``from_json`` of each line; keeps the other line columns. A malformed
    line gives a NULL payload and its text in ``_corrupt_record``; a record
    without the payload key gives a NULL payload."""
    plain = [f for f in payload_schema.fields if KEY not in f.metadata]
    other = [f for f in payload_schema.fields if KEY in f.metadata]
    schema = T.StructType([T.StructField(payload, T.StructType(plain)), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rest = [c for c in lines.columns if c != "value"]
    out = lines.select("value", *rest, parsed.alias("_rec"))
    body = F.col(f"_rec.{payload}")
    for f in other:  # JSON paths tell case apart, struct fields do not
        body = body.withField(quote(f.name), F.get_json_object("value", f"$.{payload}['{f.metadata[KEY]}']"))
    return out.select(*rest, body.alias(payload), f"_rec.{CORRUPT}")


def _flat_columns(dt: T.StructType, prefix: str, path: list[str]) -> list[tuple[str, list[str], Column]]:
    out: list[tuple[str, list[str], Column]] = []
    for f in dt.fields:
        name = f"{prefix}_{f.name}" if prefix else f.name
        ref = F.col(".".join(quote(p) for p in [*path, f.name]))
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += _flat_columns(f.dataType, name, [*path, f.name])
        else:
            out.append((name, [*path[1:], f.name], ref))
    return out


def flatten(df: DataFrame, payload: str = "_source", table: T.StructType | None = None) -> DataFrame:
    """Payload keys become top-level columns (S3); nested objects are
    flattened recursively with ``_`` joining the key path. A key whose column
    would be called like one of the line's own, or like another key's, gets
    the next free name (``a_b``, ``a_b_2``, ...).

    ``table`` is the schema of the table that the rows go to: a key that has a
    column there keeps it, and no other key's column is taken, so what a column
    holds does not depend on which keys came together."""
    rest = [c for c in df.columns if c != payload]
    columns = [] if table is None else [f for f in table.fields if f.name not in rest]
    # A key that differs from a column's in case only is the same column, as names are compared.
    known = {key_of(f).lower(): f.name for f in columns if origin_of(f) is None}
    others = {f.name.lower() for f in columns}
    taken, out = {c.lower() for c in rest}, []
    for name, path, column in _flat_columns(df.schema[payload].dataType, "", [payload]):
        key = key_path(path)
        have = known.get(key.lower())
        if have is None or have.lower() in taken:
            name = free_name(name, taken | others)
        elif have.lower() != name.lower():
            name = have
        taken.add(name.lower())
        out.append(column.alias(name) if name.lower() == key.lower() else column.alias(name, metadata={KEY_METADATA: key}))
    return df.select(*out, *[F.col(c) for c in rest])
