"""T1 with keyed state: a stream of match documents in which a corrected document replaces its rows.

The state holds, for each match, the path and the digest of the document that counts (no path if it couldn't be read): some
150 bytes a match, in the state store, dealt by match. The stream carries path, match and digest of each new file, never its
text, to the state; there the file is decided on by the rules of `keys.version_decisions` with the path as version: new, same,
replace, late, or unreadable for a broken correction, which replaces nothing. Of several files of a match in one batch the
greatest readable path is decided on, the others are late. A YAML file is parsed once for its digest and, if it is taken, once
more for its rows; the alternative sends every text through the state's shuffle.

Each batch writes its rows under a run of its own (`stream-<batch>`) and commits them to the log of drops
(`plans.drops`), whose readers and dataset serve here as well. A batch that is replayed meets the same state, so it decides
alike: if its commit is in the log it adds nothing, else it writes its run anew. A layout is fed by one such stream.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scorebook.operators.sequence import stage
from scorebook.plans.drops import committed, drops_log, tally, write_documents
from scorebook.plans.refresh import Layout
from scorebook.sources.commit_log import CommitLog
from scorebook.sources.documents import json_text, key_from_path, landed_files, parse_documents, scan_documents, yaml_to_json
from scorebook.streaming.incremental import BINARY_FILE_SCHEMA

#: Settings of a session that runs this stream: keyed state of this kind lives in the RocksDB store.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
DECIDED = "match_id string, path string, drop string, digest string, decision string"


def split_newest(files: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The one file of a match to be decided on (the greatest readable path, or the greatest path), and the others."""
    ranked = files.assign(rank=files["drop"].notna()).sort_values(["rank", "path"]).drop(columns="rank")
    return ranked.iloc[-1:], ranked.iloc[:-1]


def decide(held: tuple | None, drop: str | None, digest: str) -> str:
    """The decision on a document against the held (drop, digest); drop is null for an unreadable one."""
    if held is None:
        return "new"
    if digest == held[1]:
        return "same"
    if drop is None:
        return "unreadable"
    return "replace" if held[0] is None or drop > held[0] else "late"


class NewestDocument(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", "drop string, digest string")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - names of the interface
        best = None
        for part in rows:  # one part is held at a time, however many files a match has
            best, others = split_newest(part if best is None else pd.concat([best, part]))
            if len(others):
                yield others.assign(decision="late")
        held = tuple(self._held.get()) if self._held.exists() else None
        drop, digest = best["drop"].iloc[0], best["digest"].iloc[0]
        drop = None if pd.isna(drop) else drop
        decision = decide(held, drop, digest)
        if decision in ("new", "replace"):
            self._held.update((drop, digest))
        yield best.assign(decision=decision)

    def close(self) -> None:
        pass


def decision_stream(spark: SparkSession, layout: Layout, max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per landed file: match_id, path, drop (its path, null if unreadable), digest, decision."""
    reader = landed_files(spark.readStream.schema(BINARY_FILE_SCHEMA), layout.suffix)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(layout.landing).select("path", key_from_path("path").alias("match_id"), "content")
    docs = parse_documents(yaml_to_json(raw) if layout.suffix in ("yaml", "yml") else json_text(raw), "info struct<venue:string>")
    readable = F.col("error").isNull() & F.col("doc.info").isNotNull()
    files = docs.select("match_id", "path", F.when(readable, F.col("path")).alias("drop"),
                        F.sha2(F.coalesce("doc_json", F.concat_ws(" ", "error", "path")), 256).alias("digest"))
    return files.groupBy("match_id").transformWithStateInPandas(NewestDocument(), DECIDED, "Append", "None")


def commit_batch(layout: Layout, log: CommitLog, batch: DataFrame, batch_id: int) -> dict:
    """Writes and commits one batch of decisions; counts by decision (empty if the log has the batch already)."""
    spark, run = batch.sparkSession, f"stream-{batch_id}"
    if not log.entries(spark).where(F.col("run") == run).isEmpty():
        return {}
    decided = stage(batch, "decided")
    counts = tally(decided)
    read = decided.where(F.col("decision").isin("new", "replace", "unreadable")).select("path", "match_id")
    docs = stage(scan_documents(spark, layout.landing, layout.suffix, keys=read.select("match_id"), listing=read)
                 .select("match_id", "path", "doc", "error"), "documents")
    while True:
        head = log.head(spark) or {"number": 0, "mark": None}
        held = committed(spark, layout, log, "loaded", head["number"])
        write_documents(layout, docs, decided, held, run)
        if log.put(head["number"] + 1, run=run, mark=head["mark"], drops=[], keys=counts["new"] + counts["replace"]):
            return counts


def start_corrections_stream(spark: SparkSession, layout: Layout, checkpoint: str, available_now: bool = True,
                             max_files_per_trigger: int | None = None, log: CommitLog | None = None):
    """Starts the stream; returns the StreamingQuery. The session needs STATE_STORE."""
    log = log or drops_log(layout)
    w = (decision_stream(spark, layout, max_files_per_trigger).writeStream.outputMode("append")
         .foreachBatch(lambda batch, batch_id: commit_batch(layout, log, batch, batch_id)).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start()
