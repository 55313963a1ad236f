"""I1-I8 over a log of drops: corrected documents, runs side by side, nothing listed twice.

A drop is a folder `<landing>/<drop>/` of match documents and event files; `<landing>/<drop>.done` (any text;
Spark's listings leave empty files out) is put beside it when it is whole, and it doesn't change after that. Drops are told apart by name and ordered by name (names of dates or numbers of
one length). A run lists the markers and the folders of the drops that the log doesn't hold, so the files of earlier drops
are never listed again, and a drop that comes late under a smaller name is still found.

Every table is written by run, `<tables>/drops/<table>/run=<run>/`, and a run's rows count once the log holds its commit. The
commit is put under the number after the one that the run started from, if that number is free (sources.commit_log): of two
runs at once one is first, and the other finds its rows unused and starts again from the new head. A run that dies before
its commit leaves rows that no reader counts.

Which document of a match counts (`keys.version_decisions`): the one of the greatest drop. The same content delivered again is
skipped; other content of a later drop replaces the match's rows in all tables; other content of an earlier drop that comes
late is skipped and reported. A file that can't be read as a document replaces none (it is quarantined and reported), and any
later one replaces it. Within a drop, and among the drops of one run, the file of the greatest path counts. An event
file counts if its drop is the match's greatest with one.

The dataset has a log of its own: an entry names an index and the commit it is built up to, put in the same way. A layout is
kept either by this or by `plans.refresh.refresh`, not by both.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook import schemas
from scorebook.functions.columns import cast_to_schema
from scorebook.operators.extract import attach_events, quarantine_reasons
from scorebook.operators.keys import version_decisions
from scorebook.operators.sequence import stage
from scorebook.plans.refresh import EXTRACTORS, TABLE_SCHEMAS, Layout, build_version, indexed_rows
from scorebook.sources.commit_log import CommitLog
from scorebook.sources.documents import list_documents, scan_documents, scan_events
from scorebook.sources.tables import read_table_or_empty

RUN_SCHEMAS = {**TABLE_SCHEMAS, "loaded": schemas.LOADED, "replaced": schemas.REPLACED, "events": schemas.DROP_EVENTS,
               "quarantine": schemas.QUARANTINE}
#: Drops of one run: their names are in its commit and in the driver's memory. More drops take more runs.
MAX_DROPS = 1000
DECISIONS = ("new", "replace", "same", "late", "unreadable")


def _path(layout: Layout, name: str) -> str:
    return layout.table(f"drops/{name}")


def drops_log(layout: Layout, put_if_absent=None) -> CommitLog:
    return CommitLog(_path(layout, "log"), put_if_absent)


def dataset_log(layout: Layout, put_if_absent=None) -> CommitLog:
    return CommitLog(_path(layout, "dataset_log"), put_if_absent)


def pending_drops(spark: SparkSession, layout: Layout, log: CommitLog, upto: int, most: int = MAX_DROPS) -> tuple[str, list[str]]:
    """The landing folder as Spark names it and the first `most` drops in order of name that commits up to `upto` lack."""
    try:
        markers = spark.read.format("binaryFile").load(f"{layout.landing.rstrip('/')}/*.done").select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return layout.landing, []
    landed = markers.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("root"),
                            F.regexp_extract("path", r"([^/]+)\.done$", 1).alias("drop"))
    taken = log.entries(spark, upto).select(F.explode("drops").alias("drop"))
    rows = landed.join(taken, "drop", "left_anti").orderBy("drop").limit(most).collect()
    names = [r["drop"] for r in rows]
    odd = [n for n in names if not re.fullmatch(r"[A-Za-z0-9._=-]+", n)]
    if odd:
        raise ValueError(f"names of drops are letters, digits and . _ = -: {odd[:3]}")
    return (rows[0]["root"] if rows else layout.landing), names


def committed(spark: SparkSession, layout: Layout, log: CommitLog, name: str, upto: int | None = None) -> DataFrame:
    """The rows of a table by run (with `run`) of the commits up to `upto`, replaced matches left out."""
    runs = log.entries(spark, upto).select("run")

    def rows(table):
        schema = T.StructType([*RUN_SCHEMAS[table].fields, T.StructField("run", T.StringType())])
        return read_table_or_empty(spark, _path(layout, table), schema).join(runs, "run", "left_semi")

    if name in ("replaced", "events"):
        return rows(name)
    gone = rows("replaced").select("match_id", F.col("old_run").alias("run"))
    return rows(name).join(gone, ["match_id", "run"], "left_anti")


def current_events(spark: SparkSession, layout: Layout, log: CommitLog, upto: int | None = None) -> DataFrame:
    """(match_id, event) by the event file of each match's greatest drop."""
    return (committed(spark, layout, log, "events", upto).groupBy("match_id")
            .agg(F.max_by(F.struct("event"), "drop").alias("last")).select("match_id", "last.event"))


def current_tables(spark: SparkSession, layout: Layout, log: CommitLog, upto: int | None = None) -> dict[str, DataFrame]:
    """deliveries, match_info (with its events) and registry as the commits up to `upto` leave them."""
    out = {k: committed(spark, layout, log, k, upto).select(s.names) for k, s in TABLE_SCHEMAS.items()}
    out["match_info"] = attach_events(out["match_info"], current_events(spark, layout, log, upto))
    return out


def _listed(spark: SparkSession, root: str, drops: list[str], suffix: str) -> DataFrame:
    """path, match_id, drop of the files of `drops` (a drop without a folder has none)."""
    try:
        found = list_documents(spark, f"{root}/{{{','.join(drops)}}}", suffix)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], "path string, match_id string")
    return stage(found.withColumn("drop", F.substring_index(F.substr("path", F.lit(len(root) + 2)), "/", 1)), "listing")


def tally(decided: DataFrame) -> dict[str, int]:
    """Documents by decision."""
    return dict.fromkeys(DECISIONS, 0) | {r["decision"]: r["count"] for r in decided.groupBy("decision").count().collect()}


def _write(layout: Layout, df: DataFrame, name: str, run: str) -> None:
    """A table's rows of a run; what an attempt that died left of the run is replaced."""
    cast_to_schema(df, RUN_SCHEMAS[name]).write.mode("overwrite").parquet(f"{_path(layout, name)}/run={run}")


def write_documents(layout: Layout, docs: DataFrame, decided: DataFrame, held: DataFrame, run: str) -> None:
    """The tables' rows of a run: `docs` are the parsed documents of the decisions new, replace and unreadable, `held` has the
    run of each match that a document may replace."""
    take = decided.where(F.col("decision").isin("new", "replace"))
    _write(layout, quarantine_reasons(docs), "quarantine", run)
    if not decided.where("decision = 'unreadable'").isEmpty():
        docs = docs.join(take.select("match_id"), "match_id", "left_semi")
    for name, extract in EXTRACTORS.items():
        _write(layout, extract(docs), name, run)
    _write(layout, take.select("match_id", "drop", "digest"), "loaded", run)
    old = held.select("match_id", F.col("run").alias("old_run"))
    _write(layout, take.where("decision = 'replace'").join(old, "match_id"), "replaced", run)


def write_run(spark: SparkSession, layout: Layout, log: CommitLog, upto: int, root: str, drops: list[str], run: str) -> dict:
    """Writes the rows that `drops` add to the commits up to `upto` under `run`; counts of documents by decision."""

    listing = _listed(spark, root, drops, layout.suffix)
    keys = listing.select("match_id").distinct()
    docs = stage(scan_documents(spark, root, layout.suffix, keys=keys, listing=listing.select("path", "match_id"))
                 .select("match_id", "path", "doc", "error",
                         # without a drop a document replaces none, and any other replaces it
                         F.when(F.col("error").isNull() & F.col("doc.info").isNotNull(),
                                F.substring_index(F.substr("path", F.lit(len(root) + 2)), "/", 1)).alias("drop"),
                         F.sha2(F.coalesce("doc_json", F.concat_ws(" ", "error", "path")), 256).alias("digest")), "documents")
    held = stage(committed(spark, layout, log, "loaded", upto).join(keys, "match_id", "left_semi"), "held")
    decided = version_decisions(held, docs.select("match_id", "drop", "digest"))
    unreadable = (F.col("decision") == "late") & F.col("drop").isNull()
    decided = stage(decided.withColumn("decision", F.when(unreadable, "unreadable").otherwise(F.col("decision"))), "decided")
    counts = tally(decided)
    if counts["same"] + counts["late"]:  # else the documents stay where they were parsed
        docs = docs.join(decided.where(F.col("decision").isin("same", "late")).select("match_id"), "match_id", "left_anti")
    write_documents(layout, docs, decided, held, run)
    files = _listed(spark, root, drops, "json")
    newest = files.groupBy("match_id").agg(F.max_by("drop", "path").alias("drop"))
    events = scan_events(spark, root, only=newest, keep_invalid=True, listing=files.select("path", "match_id"))
    _write(layout, events.join(newest, "match_id"), "events", run)
    return counts


def refresh_drops(spark: SparkSession, layout: Layout, log: CommitLog | None = None, most: int = MAX_DROPS) -> dict:
    """Loads the drops that the log lacks, in order of name, `most` a run, until none is left; returns the number of drops
    and of documents by decision, and `retried`, the runs that another writer was ahead of."""
    log = log or drops_log(layout)
    report = dict.fromkeys(["drops", *DECISIONS, "retried"], 0)
    while True:
        head = log.head(spark) or {"number": 0, "mark": None}
        root, drops = pending_drops(spark, layout, log, head["number"], most)
        if not drops:
            return report
        run = f"run-{uuid.uuid4().hex}"
        counts = write_run(spark, layout, log, head["number"], root, drops, run)
        mark = max([*drops, *([head["mark"]] if head["mark"] else [])])
        if log.put(head["number"] + 1, run=run, mark=mark, drops=drops, keys=counts["new"] + counts["replace"]):
            for k, n in {**counts, "drops": len(drops)}.items():
                report[k] += n
        else:
            report["retried"] += 1


def publish_drops(spark: SparkSession, layout: Layout, log: CommitLog | None = None, built: CommitLog | None = None) -> int:
    """Brings the dataset up to the log's head: rows of the matches that later commits loaded, replaced or brought events of.
    Returns how many (match, name) pairs of these are ambiguous (decision D6)."""
    log, built = log or drops_log(layout), built or dataset_log(layout)
    while True:
        last = built.head(spark) or {"number": 0, "run": None, "upto": 0}
        head = log.head(spark)
        if head is None or head["number"] <= last["upto"]:
            return 0
        upto = head["number"]
        fresh = log.entries(spark, upto).where(F.col("number") > last["upto"]).select("run")
        loaded = committed(spark, layout, log, "loaded", upto)
        touched = (loaded.select("run", "match_id").unionByName(committed(spark, layout, log, "events", upto).select("run", "match_id"))
                   .join(fresh, "run", "left_semi"))
        keys = stage(touched.select("match_id").distinct().join(loaded.select("match_id"), "match_id", "left_semi"), "dataset-keys")
        version, ambiguous = build_version(spark, layout, _index(spark, last["run"]), keys,
                                           current_tables(spark, layout, log, upto))
        if built.put(last["number"] + 1, run=version, upto=upto):
            return ambiguous


def _index(spark: SparkSession, path: str | None) -> DataFrame:
    return (spark.createDataFrame([], schemas.DATASET_INDEX) if path is None
            else spark.read.schema(schemas.DATASET_INDEX).parquet(path))


def read_drops_dataset(spark: SparkSession, layout: Layout, built: CommitLog | None = None) -> DataFrame:
    """The dataset that the last entry of its log names."""
    last = (built or dataset_log(layout)).head(spark)
    if last is None:
        raise ValueError("no dataset has been published")
    return indexed_rows(spark, layout, _index(spark, last["run"]))

