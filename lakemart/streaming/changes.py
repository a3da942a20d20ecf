"""The incremental load as a stream: change files land in a folder and become RAW batches.

The stream's checkpoint takes the place of the watermark. Each micro-batch is one commit that
holds the RAW rows and their history row; its batch id is derived from the id that the checkpoint
gives the stream, so a batch that is replayed after a failure is recognised and skipped, while a
stream with a new checkpoint is another one.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.sources.contract import COMMERCE_CONTRACT, INCREMENTAL_DATASETS, Contract
from lakemart.sources.extracts import UPDATED_AT, as_raw_text
from lakemart.sources.lake import Files, Lake
from lakemart.sources.raw_load import (
    LOAD_HISTORY,
    NO_FILE_HASH,
    append_history,
    raw_table,
    stamp,
    utc_now,
)


def read_changes(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the Parquet change files that land in ``folder``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def already_loaded(lake: Lake, batch: str) -> bool:
    if not lake.has(LOAD_HISTORY):
        return False
    return not lake.read(LOAD_HISTORY).filter(F.col("batch_id") == batch).isEmpty()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint over all its runs."""
    # The file holds a JSON document, in some versions after a line with the format's version.
    text = Files(spark, checkpoint).read_text("metadata")
    return json.loads(text[text.index("{") :])["id"]


def append_batch(
    lake: Lake, dataset: str, rows: DataFrame, batch: str, contract: Contract = COMMERCE_CONTRACT
) -> int:
    """Append one micro-batch to RAW, once; returns the number of rows appended."""
    if already_loaded(lake, batch):
        return 0
    now = utc_now()
    uri = f"stream://{dataset}"
    text = as_raw_text(rows, contract.datasets[dataset].required_columns)
    text = text.withColumnRenamed(UPDATED_AT, "_changed")
    stamped = stamp(text, batch, now, F.lit(uri), F.col("_changed")).drop("_changed")
    with lake.transaction() as tx:
        n = tx.append(raw_table(dataset), stamped).count()
        append_history(tx, [(batch, dataset, uri, NO_FILE_HASH, n, "SUCCESS", now)])
    return n


def start(
    lake: Lake,
    dataset: str,
    changes: DataFrame,
    checkpoint: str,
    after_batch: Callable[[Lake], object] | None = None,
) -> StreamingQuery:
    """Load all changes available now, batch by batch; ``after_batch`` may build the models.

    ``checkpoint`` is a folder all executors share. Streams of one lake run one at a time.
    """
    if dataset not in INCREMENTAL_DATASETS:
        raise ValueError(f"data set has no incremental extract: {dataset}")

    def load(rows: DataFrame, number: int) -> None:
        stream = stream_id(lake.spark, checkpoint)
        append_batch(lake, dataset, rows, f"stream-{dataset}-{stream}-{number}")
        if after_batch:
            after_batch(lake)

    return (
        changes.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
