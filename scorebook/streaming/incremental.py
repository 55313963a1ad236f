"""Incremental refresh as a file stream (the streaming twin of plans.refresh).

The file source's checkpoint records which files were processed, so each trigger
sees only files not seen before. Every micro-batch is parsed once, quarantined, and
appended with the same idempotent append as the batch job (a replayed batch after a
failure adds nothing twice). `trigger(availableNow=True)` drains what has landed and
stops; drop it for a continuous stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorebook.operators.extract import quarantine_reasons
from scorebook.operators.sequence import stage
from scorebook.plans.refresh import (EXTRACTORS, TABLE_SCHEMAS, Layout, append_keys, append_new, append_new_events,
                                     append_problems)
from scorebook.sources.documents import json_text, key_from_path, landed_files, parse_documents, yaml_to_json

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def document_stream(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = landed_files(spark.readStream.schema(BINARY_FILE_SCHEMA), layout.suffix)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(layout.landing).select("path", key_from_path("path").alias("match_id"), "content")
    texts = yaml_to_json(raw) if layout.suffix in ("yaml", "yml") else json_text(raw)
    return parse_documents(texts)


def process_batch(layout: Layout, batch: DataFrame, batch_id: int) -> None:
    """One micro-batch, by the same writes as the batch job: running it again changes nothing."""
    spark = batch.sparkSession
    docs = stage(batch.select("match_id", "path", "doc", "error"), "documents")
    for name, extract in EXTRACTORS.items():
        append_new(spark, extract(docs), layout.table(name), TABLE_SCHEMAS[name])
    append_problems(spark, layout, quarantine_reasons(docs))
    append_new_events(spark, layout)
    append_keys(spark, layout, docs, f"stream-{batch_id}")


def start_refresh_stream(spark: SparkSession, layout: Layout, checkpoint: str,
                         available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery (call awaitTermination())."""
    w = (document_stream(spark, layout, max_files_per_trigger).writeStream
         .foreachBatch(lambda batch, batch_id: process_batch(layout, batch, batch_id)).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
