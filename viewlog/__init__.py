"""viewlog: a Spark-native medallion pipeline over viewing logs.

raw JSON lines -> bronze (offset-batched ingest) -> silver (per-contract
usage pivot) -> gold (behaviour features) -> keyed serving table + views.
"""

__version__ = "0.1.0"
