"""Stage new bronze files as they arrive (file source -> parquet sink).

Only stateless operators are streamable: each input row maps to at most one
output row, so exactly-once output follows from the file source's offset log
and the sink's commit log in the checkpoint folder.  The invoice dedup keeps
the *earliest-dated* copy, which a stream cannot decide before all copies
have arrived; it therefore stays in the batch path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarterlens.operators import staging
from quarterlens.session import ensure_checkpoint_dir

STREAMABLE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stg_subscriptions": staging.stage_subscriptions,
    "stg_usage_events": staging.stage_usage_events,
    "stg_customers": staging.stage_customers,
}


def stage_stream(spark: SparkSession, table: str, source_path: str, schema: str,
                 sink_path: str, checkpoint_path: str | None = None,
                 available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that stages every new bronze file of ``table``.

    ``checkpoint_path`` defaults to ``<spark.checkpoint.dir>/streams/<table>``
    (shared storage on a cluster).  With ``available_now`` the query processes
    what is there in bounded micro-batches and stops, the incremental
    counterpart of a scheduled rebuild.
    """
    if table not in STREAMABLE:
        raise ValueError(f"{table} is not stateless-stageable; use the batch path")
    if checkpoint_path is None:
        checkpoint_path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{table}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    staged = STREAMABLE[table](reader.parquet(source_path))
    writer = (staged.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start(sink_path)
