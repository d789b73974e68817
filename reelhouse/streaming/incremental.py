"""Periodic loads: new landing files are merged into a stage table once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reelhouse.operators.load import latest_per_key, merge_into_table
from reelhouse.plans.pipeline import FILE_COLUMNS, merge_rows
from reelhouse.plans.stage import STAGE_MODELS, RunTime
from reelhouse.schemas import ENTITIES
from reelhouse.session import estimated_bytes, sized_shuffles
from reelhouse.sources.landing import landing_path, scan
from reelhouse.sources.snapshots import SnapshotTable

_QUERY_ID = "sql.streaming.queryId"


def stream_stage(
    spark: SparkSession,
    root: str,
    name: str,
    table: SnapshotTable | str,
    checkpoint: str,
    every: str | None = None,
    run_ts: RunTime = None,
    dedupe: str | None = None,
    input_bytes: int | None = None,
    newest: tuple[str, ...] = (),
) -> StreamingQuery:
    """Start merging an entity's new landing files into its stage table.

    By default the query takes what has arrived and stops; `every="30 minutes"` keeps it
    running on that period. The checkpoint remembers the files taken, and the table
    remembers the last micro-batch, so a batch repeated after a failure changes nothing.
    A table given by name must exist in a catalog whose format supports MERGE; it is then
    changed in place, at a cost that follows the new rows and not the table.
    With `dedupe="latest"` the last landed row of a key wins within a micro-batch;
    otherwise a key that comes twice and is already in the table is an error.

    `newest` names columns of the landing rows, or of their files (`landed_at`, `landed_in`), that
    are stored with each row. A key then keeps the row that comes last by them over all batches,
    so an old file that arrives late does not undo a newer one.
    """
    if dedupe not in (None, "latest"):
        raise ValueError(f"dedupe must be None or 'latest', not {dedupe!r}")
    entity, model = ENTITIES[name], STAGE_MODELS[name]
    if input_bytes is None:
        input_bytes = estimated_bytes(scan(spark, root, name))
    arrivals = (
        spark.readStream.schema(entity.schema)
        .option("recursiveFileLookup", True)
        .parquet(landing_path(root, entity))
        .select("*", "_metadata.file_modification_time", "_metadata.file_path")
        .withColumnsRenamed(dict(zip(("file_modification_time", "file_path"), FILE_COLUMNS)))
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        if isinstance(table, SnapshotTable):
            stream = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
            last = table.last_batch(stream)
            if last is not None and last >= batch_id:
                return
        carried = tuple(dict.fromkeys((*newest, *FILE_COLUMNS)))
        staged = model.build(batch, run_ts, carry=carried)
        # a snapshot table compares by `newest` itself, with what it holds, in one shuffle
        compared = newest and isinstance(table, SnapshotTable)
        if not compared and (newest or dedupe == "latest"):
            staged = latest_per_key(staged, model.key, newest or FILE_COLUMNS)
        staged = staged.drop(*(c for c in FILE_COLUMNS if c not in newest))
        if isinstance(table, SnapshotTable):
            merge_rows(table, model, staged, stream, batch_id, newest=newest)
        else:
            merge_into_table(staged, table, model.key, newest)

    writer = arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    # a stream keeps the settings of the session that it is started in
    with sized_shuffles(spark, input_bytes):
        return writer.trigger(**trigger).start()
