"""Redelivery safeguard (off by default): a record that a bus delivers again is taken once.

The state holds one key per record for as long as a redelivery is expected,
in RocksDB on the executors' disks, and survives restarts in the query's
checkpoint. The window is one of arrival, not of event time: a record that
is late by its own clock is new and must not be lost, so no record is ever
dropped for its age.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machinewatch.schema import RETENTION

#: State that grows with the input belongs on disk.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def record_key(records: DataFrame, id_field: str = "event_id") -> Column:
    """What makes two records the same: the message id in ``raw`` if there is one, else the whole content."""
    content = F.concat(F.lit("content:"), F.sha2(F.to_json(F.struct(*records.columns)), 256))
    if "raw" not in records.columns:
        return content
    return F.coalesce(F.concat(F.lit("id:"), F.get_json_object("raw", f"$.{id_field}")), content)


def drop_redelivered(records: DataFrame, within: str = RETENTION, key: Column | None = None) -> DataFrame:
    """Each record once, if its copies arrive within ``within`` of each other.

    On a batch frame all copies are dropped. Columns stay as they are; records
    whose fields are all null count as copies of each other.
    """
    name, arrival = "_record_key", "_arrival"
    keyed = records.withColumn(name, record_key(records) if key is None else key)
    if not records.isStreaming:
        return keyed.dropDuplicates([name]).drop(name)
    timed = keyed.withColumn(arrival, F.current_timestamp()).withWatermark(arrival, within)
    return timed.dropDuplicatesWithinWatermark([name]).drop(name, arrival)
