"""Corpus pipeline over the operators of scorebook.llm.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir), where docs has
the columns of documents, and returns a DataFrame that is written as Parquet and reread as
the next one's docs. All but the last return the columns of documents. A stage works on
all that the stage before kept:

1. quality: documents that a quality rule rejects go.
2. near_dedup: one row of each near-duplicate component stays, the smallest id (null ids last).
3. substring_dedup: words inside windows that a document with a smaller id holds too go;
   a text that loses words becomes its kept words joined by one space, and n_chars follows.
   A document left without words goes.
4. decontamination: documents that hold a benchmark window go.
5. sentencepiece: doc_id, lang, source, text as encoded and decoded again, n_tokens and
   ids_sha256 of the piece ids.

Null and empty texts have no words, so the first stage rejects them; rows with null ids
take part in near_dedup and pass through the others. Empty tables stay empty.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm import decontamination, near_duplicates, pieces, quality, substrings
from scorebook.llm.frames import stage, table
from scorebook.llm.token_counts import check_model, prepared
from scorebook.llm.words import chunks


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substrings.without_repeats(docs)
    changed = out.where(F.col("text") != "")
    return changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.vocabulary()
    check_model(model)
    shared = spark.sparkContext.broadcast(model)  # the vocabulary file, of fixed size
    rows = docs.select("doc_id", "lang", "source", "text")

    def run(batches):
        for batch in batches:
            for a, b, t in chunks(pa.RecordBatch.from_arrays([prepared(batch.column(3))], ["text"])):
                codec = pieces.codec(shared.value)
                ids, offs = codec.encode(t)
                little = ids.astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(3)] + [
                        codec.decode(ids, offs), pa.array(offs[1:] - offs[:-1], pa.int64()),
                        pa.array([hashlib.sha256(little[x:y].tobytes()).hexdigest() for x, y in zip(offs, offs[1:])],
                                 pa.string())],
                    names=["doc_id", "lang", "source", "text", "n_tokens", "ids_sha256"])

    return rows.mapInArrow(run, "doc_id bigint, lang string, source string, text string, n_tokens bigint, ids_sha256 string")


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: SQL can't express the last stage (and the second only by all pairs); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
