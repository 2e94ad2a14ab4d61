"""Pages as a stream: detections that arrive in files are finished page by page.

A page is whole within its file, so each micro-batch goes through the batch plan; nothing is kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.page import page_items

DETECTIONS = "page_id long, tile_id long, scale double, det_idx long, text string, x0 long, y0 long, x1 long, y1 long, confidence double"


def finish_stream(spark: SparkSession, source: str, tiles: DataFrame, sink: str, checkpoint: str, files: int = 4) -> StreamingQuery:
    """Read detections (Parquet files below ``source``) and append the pages' final items below ``sink``, a batch at a time.

    Batches are written below their own number, so one that is run again after a failure replaces what it had written.
    """
    stream = spark.readStream.schema(DETECTIONS).option("maxFilesPerTrigger", files).parquet(source)

    def finish(batch: DataFrame, number: int) -> None:
        page_items(batch, tiles).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.foreachBatch(finish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
