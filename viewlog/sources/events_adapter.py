"""The ``events`` test table seen as viewing-log rows.

Maps each event to one bronze record so every stage runs on the provided
data and grows with it. The DuckDB oracle uses the same mapping
(``plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C

# --- fixed values: app code of an event is CODES[event_id % 15] ---------------
# Every mapped code once, in rule order, plus one unmapped code.
CODES = (
    "CHANNEL", "DSHD", "KPLUS", "KPlus", "VOD", "FIMS_RES", "BHD_RES", "VOD_RES",
    "FIMS", "BHD", "DANET", "RELAX", "CHILD", "SPORT", "OTHER",
)
# --- end of fixed values -------------------------------------------------------

EVENT_COLUMNS = ("event_id", "ts", "user_id", "value", "props")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


def contract_of(user_id: Column, k: Column, dense: bool = False) -> Column:
    if dense:
        return user_id.cast("string")
    # Raw JSON text: try_cast, so a malformed value gives NULL under ANSI mode.
    return (user_id * 10 + k.try_cast("bigint") % 10).cast("string")


def app_of(event_id: Column | str = "event_id") -> Column:
    if isinstance(event_id, str):
        arr = ", ".join("'" + c + "'" for c in CODES)
        return F.expr(f"element_at(array({arr}), CAST(`{event_id}` % {len(CODES)} + 1 AS INT))")
    codes = F.array(*[F.lit(c) for c in CODES])
    return F.element_at(codes, (event_id % len(CODES) + 1).cast("int"))


def events_as_bronze(events: DataFrame, dense: bool = False, keep_event_id: bool = False,
                     extra: tuple[str, ...] = ()) -> DataFrame:
    """Bronze columns (Contract, Mac, TotalDuration, AppName, execution_date,
    source_file) from ``events``; ``execution_date`` is the event's day.
    ``extra`` event columns are carried along in the same projection.

    Only the needed columns are read (column pruning reaches the scan).
    """
    ev = events.select(*EVENT_COLUMNS, *[c for c in extra if c not in EVENT_COLUMNS]).withColumn(
        "_k", _k(F.col("props"))
    )
    cols = [
        contract_of(F.col("user_id"), F.col("_k"), dense).alias(C.CONTRACT),
        F.col("_k").alias(C.MAC),
        F.round(F.col("value") * 100).cast("bigint").alias(C.DURATION),
        app_of("event_id").alias(C.APP),
        F.date_format("ts", "yyyy-MM-dd").alias(C.EXEC_DATE),
        F.date_format("ts", "yyyyMMdd").alias(C.SOURCE_FILE),
    ]
    if keep_event_id:
        cols.insert(0, F.col("event_id"))
    cols += [F.col(c) for c in extra]
    return ev.select(*cols)


def bronze_from_dir(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    return events_as_bronze(read_events(spark, sf_dir), dense)


def source_records(events: DataFrame) -> DataFrame:
    """Raw log records as the source system writes them: the payload under
    ``_source`` (with one nested object and one key the bronze declaration
    does not know), plus envelope keys and the file the record belongs to."""
    ev = events.select(*EVENT_COLUMNS, "event_type").withColumn("_k", _k(F.col("props")))
    sf = F.date_format("ts", "yyyyMMdd")
    payload = F.struct(
        contract_of(F.col("user_id"), F.col("_k")).alias(C.CONTRACT),
        F.col("_k").alias(C.MAC),
        F.round(F.col("value") * 100).cast("bigint").alias(C.DURATION),
        app_of("event_id").alias(C.APP),
        F.col("event_type").alias("EventType"),
        F.struct(sf.alias("file"), F.col("event_id").alias("seq")).alias("meta"),
    )
    return ev.select(
        F.col("event_id").alias("_id"),
        F.lit("viewing-log").alias("_index"),
        payload.alias("_source"),
        sf.alias(C.SOURCE_FILE),
    )


# Shares of the odd lines in ``odd_lines``: every so many events, from this one on.
MALFORMED = (17, 3)
NO_PAYLOAD = (19, 5)
NO_APP = (23, 7)


def odd_lines(events: DataFrame) -> DataFrame:
    """The log as text lines (``value``) with malformed lines, records without
    a payload, and payloads without an app code in fixed places."""
    recs = source_records(events)

    def every(share: tuple[int, int]) -> Column:
        return F.col("_id") % share[0] == share[1]

    line = (
        F.when(every(MALFORMED), F.concat(F.lit('{"_id": '), F.col("_id").cast("string"), F.lit(', "_source": {')))
        .when(every(NO_PAYLOAD), F.to_json(F.struct("_id", "_index")))
        .when(every(NO_APP), F.to_json(F.struct("_id", "_index", F.col("_source").dropFields(C.APP).alias("_source"))))
        .otherwise(F.to_json(F.struct("_id", "_index", "_source")))
    )
    return recs.select(line.alias("value"), C.SOURCE_FILE, "_id")


def write_odd_log(events: DataFrame, path: str) -> None:
    """``odd_lines`` as one directory per source file, its part files in name order holding it in ``_id`` order."""
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = odd_lines(events).repartitionByRange(n, C.SOURCE_FILE, "_id").sortWithinPartitions(C.SOURCE_FILE, "_id")
    lines.drop("_id").write.partitionBy(C.SOURCE_FILE).text(path)


def write_source_log(events: DataFrame, path: str, per_file: bool = False, files: int | None = None,
                     whole: bool = False, mode: str = "errorifexists") -> None:
    """Write the records as JSON lines in ``_id`` order.

    ``per_file`` writes one directory per source file (``source_file=...``)
    whose part files, in name order, hold that day's records in ``_id`` order;
    a day is range-partitioned too, so no task writes a whole day, unless
    ``whole`` asks for one file per day. Else one directory whose part files, in name
    order, hold all records in order (range partitioning on ``_id`` keeps
    that write parallel).
    """
    n = files or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Spread before the records are built: cutting ranges samples its input, which then is a plain scan.
    day = F.date_format("ts", "yyyyMMdd")
    if per_file:
        spread = events.repartition(n, day) if whole else events.repartitionByRange(n, day, "event_id")
        by_day = source_records(spread).sortWithinPartitions(C.SOURCE_FILE, "_id")
        by_day.write.mode(mode).partitionBy(C.SOURCE_FILE).json(path)
    else:
        spread = events.repartitionByRange(n, "event_id")
        source_records(spread).sortWithinPartitions("_id").drop(C.SOURCE_FILE).write.json(path)
