"""Bronze ingest with Structured Streaming.

The checkpoint remembers which files were read, so a run takes what arrived
since the last one, late files of earlier days included, and then ends.  Each
micro-batch is a load named by its files and goes through the same writer as the daily
run: a retry replaces its own rows, and files that the daily run took are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postlake.plans.daily import Lake, write_bronze
from postlake.sinks import ledger
from postlake.sources.landing import json_lines, whole_rows
from postlake.sources.registry import Source, load_schema


def read_landing_stream(
    spark: SparkSession, lake: Lake, source: Source, files_per_batch: int = 10_000
) -> DataFrame:
    """Rows of all landing files of a source, below any year=/month=/day= directory, with theirs."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("basePath", lake.landing)
    found = json_lines(reader, load_schema(source.name, lake.schema_dir)).json(
        f"{lake.landing.rstrip('/')}/year=*/month=*/day=*/{source.name}_jobs.json"
    )
    return ledger.with_file(found.drop("year", "month", "day"))


def write_batch(batch: DataFrame, lake: Lake, source: Source, ingested_at: Column | None = None) -> None:
    """One micro-batch into bronze, under the name of its files (listed without parsing them).

    Its bad lines are filed under the first day it read, the same at every attempt."""
    files = ledger.files_in(batch)
    if not files:
        return
    load = ledger.load_of_files(files)
    first = min(file for file, _ in files).rsplit("/year=", 1)[1].split("/")
    aside = f"{lake.quarantine}/{source.name}_jobs/year={'/'.join(first[:3])}/load={load}"
    rows = whole_rows(batch, ledger.FILE, ledger.MODIFIED)
    write_bronze(rows, lake, source.name, load, aside, ingested_at)


def ingest_available(
    spark: SparkSession,
    lake: Lake,
    source: Source,
    checkpoint: str,
    ingested_at: Column | None = None,
) -> StreamingQuery:
    """Append everything that arrived since the last run to bronze, then stop."""
    return (
        read_landing_stream(spark, lake, source)
        .writeStream.foreachBatch(lambda batch, _: write_batch(batch, lake, source, ingested_at))
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{source.name}")
        .trigger(availableNow=True)
        .start()
    )
