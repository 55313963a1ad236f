"""Small DataFrame helpers of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.shared_files import map_arrays, write_arrays
from scorebook.llm.words import chunks, pack_texts
from scorebook.session import checkpoint_dir, default_partitions, freed_shuffles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` under spark.checkpoint.dir and read it back: cuts lineage, survives lost executors, ends the
    shuffles of the write with it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return default_partitions(spark)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of all rows; other columns are left out, whatever their names."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def sample_texts(docs: DataFrame, n: int, max_bytes: int = 1 << 16) -> pa.RecordBatch:
    """At most `n` texts of at most `max_bytes` bytes each (so n * max_bytes bytes), for estimates only.

    A plain limit, read from as few files as it needs; a sampled share would scan them all."""
    rows = docs.where(F.octet_length("text") <= max_bytes).select("text").limit(n).collect()
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string())], ["text"])


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow where `fn` turns a batch into dicts of column -> list or array."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "binary": pa.binary(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()),
             "array<bigint>": pa.list_(pa.int64())}
    names, types = [f[0] for f in fields], [kinds[f[1]] for f in fields]

    def run(batches):
        for b in batches:
            for out in fn(b):
                yield pa.RecordBatch.from_arrays(
                    [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], t) for n, t in zip(names, types)],
                    names=names)

    return df.mapInArrow(run, schema)


def packed_texts(df: DataFrame) -> DataFrame:
    """`df` (keys of type bigint, and `text`) with each text compressed, for shuffles of whole texts."""
    keys = [c for c in df.columns if c != "text"]

    def run(batch):
        for a, b, t in chunks(batch):
            yield {**{k: batch.column(i).slice(a, b - a) for i, k in enumerate(keys)}, "text": pack_texts(t)}

    return per_batch(df.select(*keys, "text"), run, ", ".join(f"{k} bigint" for k in keys) + ", text binary")


@lru_cache(maxsize=4)
def _numbers(folder: str, part: int) -> np.ndarray:
    return map_arrays(folder, f"part-{part}")["n"]


def without_numbers(rows: DataFrame, number: str, gone: DataFrame) -> DataFrame:
    """`rows` less those whose `number` is in `gone` (column n). The numbers are of monotonically_increasing_id and stored
    with the rows.

    Rows with their texts are not shuffled: the numbers of a partition (their upper bits) lie together in the stored rows,
    so those to leave out go to a file per partition in the checkpoint folder, and the tasks that read rows look them up."""
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-gone-{uuid.uuid4().hex}"
    lists = gone.where("n is not null").groupBy(F.shiftright("n", 33).alias("part")).agg(F.array_sort(F.collect_list("n")).alias("l"))

    def write(batches):
        for batch in batches:
            for part, numbers in zip(batch.column(0).to_pylist(), batch.column(1)):
                write_arrays(folder, f"part-{part}", {"n": numbers.values.to_numpy(zero_copy_only=False)})
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64())], names=["part"])

    with freed_shuffles(spark):
        written = {r[0] for r in lists.mapInArrow(write, "part bigint").collect()}

    @F.pandas_udf("boolean")
    def stays(n: pd.Series) -> pd.Series:
        n = n.to_numpy()
        out, parts = np.ones(len(n), bool), n >> 33
        for part in written & set(np.unique(parts).tolist()):
            out[parts == part] = ~np.isin(n[parts == part], _numbers(folder, part))
        return pd.Series(out)

    return rows.where(stays(number)) if written else rows
