"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every job here. AQE coalesces the small shuffles of
# the per-contract aggregates, converts joins to broadcast only after it has
# measured the built side, and splits skewed sort-merge partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition columns such as execution_day stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "viewlog",
                  extra: dict | None = None) -> SparkSession:
    """A session for tests, benches and local runs.

    On a cluster the submitting environment supplies master, memory and the
    shared checkpoint directory; only the SQL settings above are ours.
    """
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable SQL settings to an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static conf on a shared session
                pass


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide directory for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or a directory already set on the
    context). When the session has none, a local master gets a fresh local
    directory; any other raises, as its executors would not see one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="viewlog-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared directory."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.1,
               max_partitions: int | None = None) -> dict[str, str]:
    """SQL settings for a cluster run over ``input_bytes`` of bronze.

    * scans: 256 MiB splits (columnar reads of a few columns stay short);
    * shuffles: the widest exchange here carries per-(contract, file)
      partials, estimated at ``shuffle_fraction`` of the input after
      map-side aggregation; start with about 200 MiB per partition (at least
      2 per core, at most ``max_partitions`` if given) and let AQE coalesce small ones;
    * skew: AQE splits sort-merge partitions over 512 MiB (and 5x median);
    * broadcasts: Spark's own size check, raised to a fixed 64 MiB;
    * streaming state: RocksDB, so per-contract state can exceed memory.
    """
    shuffle = int(input_bytes * shuffle_fraction)
    parts = max(2 * total_cores, shuffle // (200 << 20))
    if max_partitions:
        parts = min(parts, max_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, total_cores: int | None = None) -> dict[str, str]:
    cores = total_cores or spark.sparkContext.defaultParallelism
    conf = scale_conf(input_bytes, cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
