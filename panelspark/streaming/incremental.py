"""Incremental ingest of landed transaction files.

`readStream` over the landing folder (`Trigger.AvailableNow`: process what
has landed, then stop) with `foreachBatch`:

1. the batch's raw rows are written to the raw store partitioned by
   (month, batch id) with a dynamic partition overwrite, so a retried batch
   replaces its own rows instead of duplicating them;
2. the (entity, month) keys the batch touches are recomputed from ALL raw
   rows of those months (partition-pruned), so a restated month replaces
   the loaded value -- as a key upsert does -- rather than adding to it;
3. the recomputed keys are upserted into the flow table, whose partitions are
   months: those that the batch does not touch are carried over as they are.

Streaming progress lives in the query's checkpoint folder in the shared
checkpoint root, so a restarted job resumes after the last committed batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.clean import load_flow
from panelspark.sources.warehouse import read_table, upsert_table

KEYS = ("entity", "month")


def incremental_ingest(spark: SparkSession, landing_dir: str, schema, store_root: str, *,
                       entities: DataFrame | Sequence[str] | None = None, electric: str = "Electric",
                       date_col: str = "txn_date", max_files_per_trigger: int | None = None) -> DataFrame:
    raw_root = f"{store_root.rstrip('/')}/raw"
    flow_root = f"{store_root.rstrip('/')}/flow"
    ckpt = f"{store_root.rstrip('/')}/_stream_checkpoint"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)

    def month_of(df):
        is_text = dict(df.dtypes)[date_col] == "string"
        from panelspark.functions import to_month
        return to_month(date_col, is_text=is_text)

    def process(batch: DataFrame, batch_id: int) -> None:
        staged = batch.withColumn("_month", month_of(batch)).withColumn("_batch", F.lit(batch_id))
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_month", "_batch").parquet(raw_root)
        months = [r[0] for r in staged.select("_month").distinct().collect()]  # bounded by the months in one batch
        if not months:
            return
        raw = spark.read.parquet(raw_root).where(F.col("_month").isin(months)).drop("_month", "_batch")
        touched = load_flow(batch, entities, electric=electric).select(*KEYS)
        fresh = load_flow(raw, entities, electric=electric).join(touched, list(KEYS), "left_semi")
        upsert_table(spark, flow_root, fresh, KEYS, by="month")

    q = stream.writeStream.foreachBatch(process).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return read_table(spark, flow_root)
