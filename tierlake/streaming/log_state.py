"""The operations log's latest attempts, kept as state of a stream.

Each file's state is its latest attempt (all of them where dates tie); it lives in the
stream's state store, so a run reads only what is new and a restart goes on from the
checkpoint. An attempt that arrives late with an older date changes nothing. Every
micro-batch puts the files that changed into a stored table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tierlake.schemas import OPLOG_SCHEMA
from tierlake.session import shared_dir
from tierlake.sinks.tables import PartitionedTable

# Folders of the stored table: files are dealt to them by name.
BUCKETS = 16
_DATED = "fileName string, downloadURL string, status string, updated_date string, error string"
_COLUMNS = OPLOG_SCHEMA.fieldNames()


def latest_table(spark: SparkSession, root: str) -> PartitionedTable:
    """The stored table of latest attempts (``OPLOG_SCHEMA``)."""
    return PartitionedTable(spark, root, OPLOG_SCHEMA, ["bucket"], {"bucket": f"pmod(xxhash64(fileName), {BUCKETS})"})


def _latest(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of the greatest date; undated ones only where no row has a date. Dates are ISO
    texts of one length, so they order like times."""
    dated = rows[rows["updated_date"].notna()]
    return dated[dated["updated_date"] == dated["updated_date"].max()] if len(dated) else rows


def _update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """New latest rows of one file; a long run of attempts is reduced part by part."""
    before = state.get[0] if state.exists else "[]"
    best = pd.DataFrame(json.loads(before), columns=_COLUMNS)
    for part in parts:
        best = _latest(pd.concat([best.astype(object), part[_COLUMNS].astype(object)], ignore_index=True))
    best = best.astype(object).where(best.notna(), None)
    now = json.dumps(best.values.tolist())
    if now != before:
        state.update((now,))
        yield best


def latest_attempts(stream: DataFrame) -> DataFrame:
    """A streaming log as the latest rows of the files that changed in each micro-batch."""
    text = F.date_format("updated_date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    changed = stream.withColumn("updated_date", text).groupBy("fileName").applyInPandasWithState(
        _update, _DATED, "latest string", "update", GroupStateTimeout.NoTimeout)
    return changed.withColumn("updated_date", F.to_timestamp_ntz("updated_date", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))


def follow_log(spark: SparkSession, source: str, root: str, *, pattern: str = "*.parquet", checkpoint: str | None = None,
               read=lambda df: df, schema=OPLOG_SCHEMA) -> StreamingQuery:
    """Start a run over the log files under ``source`` that are new since the last one; it stops
    when they are done. ``read`` maps rows of ``schema`` to log rows."""
    key = hashlib.sha256(f"{source}\n{root}".encode()).hexdigest()[:32]
    checkpoint = checkpoint or shared_dir(spark, "tierlake", "streams", key)
    table = latest_table(spark, root)
    mark = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def put(rows: DataFrame, epoch: int) -> None:
        # The batch evaluates its rows several times; state must be asked once.
        rows = rows.persist()
        try:
            table.replace(rows, ["fileName"], rows.select("fileName").distinct(), f"{mark}-{epoch}")
        finally:
            rows.unpersist()

    files = (spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
             .parquet(source))
    return (latest_attempts(read(files)).writeStream.outputMode("update").foreachBatch(put)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
