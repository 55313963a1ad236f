"""Exact substring dedup over words by fixed-block anchors.

A window of `window` words that a document shares with another holds, wherever it starts,
one whole block of the other's fixed grid of blocks of (window + 1) // 2 words. So the
grid blocks of all documents are the index, and every rolling block-sized window of all
documents probes it. Hits are extended: the windows around a hit block are fingerprinted
whole, and those that also start in a document with a smaller id are removed; runs of
such windows are the maximal exact repeats.

Both steps are meetings of fingerprints (scorebook.llm.meeting): 39 bits and a bucket
number for the probes, which only select candidates, and 64 bits for the windows. A
window of another wording is taken for equal with a chance of about (candidate
windows) / 2**64.

Documents with null or empty text have no words and lose none. Rows that repeat an id are
one document to the rule ("a smaller id") and are cleaned one by one; rows with a null id
take no part and stay whole. Texts are read whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.llm.frames import keyed_texts, packed_texts, partitions, per_batch, table
from scorebook.llm.meeting import key_set, member, own_codes, shared_keys
from scorebook.llm.words import Texts, chunks, doc_of, pack_texts, packed_chunks, windows

WINDOW = 13


#: Stands for a null id, so that both joins with the texts can share one shuffle of them.
NO_ID = -(1 << 63)


def _texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False)


def _near(hit: np.ndarray, pos: np.ndarray, block: int, window: int) -> np.ndarray:
    """Of the window starts `pos`, those whose window holds a whole hit block (flags per word position)."""
    c = np.concatenate([[0], np.cumsum(hit)])
    last = window - block + 1
    return pos[c[np.minimum(pos + last, len(hit))] > c[pos]]


def removed_words(docs: DataFrame, packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, keys: the fingerprints of each document's windows that a smaller id holds too. `docs` as from
    `_texts`, and `packed` the same texts compressed (doc_id, text and any others, all of which go into the join: the
    caller's own join of them can then use the same exchange)."""
    block = (window + 1) // 2
    n = partitions(docs.sparkSession)

    def probes(batch):
        ids = _ids(batch)
        for a, b, t in chunks(batch):
            h, w = t.words()
            pos, g = windows(h, w, block, 1)
            doc = doc_of(w)[pos]
            if (ids[a:b] == NO_ID).any():
                known = ids[a + doc] != NO_ID
                pos, g, doc = pos[known], g[known], doc[known]
            yield ids[a:b], doc, g, (pos - w[doc]) % block == 0

    anchors = shared_keys(docs, probes, exact=False)
    others = [c for c in packed.columns if c not in ("doc_id", "text")]
    candidates = packed.join(anchors, "doc_id").select("doc_id", "text", "keys", *others)

    def candidate_windows(batch):
        ids = _ids(batch)
        keys = batch.column(2)
        for a, b, t in packed_chunks(batch.column(1)):
            h, w = t.words()
            bpos, bh = windows(h, w, block, 1)
            own = own_codes(bh, n, False)
            hit = np.zeros(len(h) + 1, bool)
            cut = np.searchsorted(bpos, w)
            for i in range(b - a):
                x, y = cut[i], cut[i + 1]
                hit[bpos[x:y][member(own[x:y], key_set(keys[a + i].as_py()))]] = True
            pos, g = windows(h, w, window, 2)
            near = np.searchsorted(pos, _near(hit, pos, block, window))
            yield ids[a:b], doc_of(w)[pos[near]], g[near], None

    return shared_keys(candidates, candidate_windows, exact=True, earlier=True)


def covered(t: Texts, keys: list, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word, whether a window with one of the document's keys covers it; word offsets."""
    h, w = t.words()
    cover = np.zeros(len(h) + 1, np.int32)
    some = [i for i, k in enumerate(keys) if k]
    if some:
        pos, g = windows(h, w, window, 2)
        cut = np.searchsorted(pos, w)
        for i in some:
            x, y = cut[i], cut[i + 1]
            at = pos[x:y][member(g[x:y], key_set(keys[i]))]
            cover[at] += 1
            np.subtract.at(cover, at + window, 1)
    return np.cumsum(cover)[:-1] > 0, w


def with_removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id (NO_ID for null), text (packed), keys of every row of `docs`."""
    texts = _texts(docs)
    packed = packed_texts(texts).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))  # not null to the planner
    return packed.join(removed_words(texts, packed, window), "doc_id", "left").select("doc_id", "text", "keys")


def dedup_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) of every row."""

    def run(batch):
        keys = batch.column(2)
        for a, b, t in packed_chunks(batch.column(1)):
            gone, w = covered(t, keys.slice(a, b - a).to_pylist(), window)
            s, e, _ = t.spans()
            digests = [_digest(t, s, e, gone, w[i], w[i + 1], i) for i in range(b - a)]
            c = np.concatenate([[0], np.cumsum(gone)])
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_words": np.diff(w), "n_removed": c[w[1:]] - c[w[:-1]],
                   "kept_sha256": digests}

    out = per_batch(with_removals(docs, window), run,
                    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def kept_text(t: Texts, s, e, gone, x: int, y: int, i: int) -> bytes:
    """The kept words of text i (words x to y), joined by one space."""
    words = t.bytes_of(i).split()
    if gone[x:y].any():
        words = [words[j] for j in np.flatnonzero(~gone[x:y])]
    return b" ".join(words)


def _digest(t, s, e, gone, x, y, i) -> str:
    return hashlib.sha256(kept_text(t, s, e, gone, x, y, i)).hexdigest()


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with all its columns and rows; texts that lose words become their kept words joined by one space
    (possibly empty), all others stay as they are, null included."""
    names = docs.columns
    rest = [c for c in names if c != text_col]
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])

    def pack(batches):
        for batch in batches:
            known = pc.is_valid(batch.column(1)).to_pylist()
            for a, b, t in chunks(batch):
                texts = pa.array([x if k else None for x, k in zip(pack_texts(t), known[a:b])], pa.binary())
                yield pa.RecordBatch.from_arrays([texts if i == 1 else batch.column(i).slice(a, b - a) for i in range(len(names) + 1)],
                                                 names=batch.schema.names)

    kinds = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in rows.schema.fields])
    packed = rows.mapInArrow(pack, kinds).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    gone = removed_words(_texts(docs, id_col, text_col), packed, window)
    both = packed.join(gone, "doc_id", "left").select("text", "keys", *[f"c{i}" for i in range(len(rest))])

    def run(batches):
        for batch in batches:
            for a, b, t in packed_chunks(batch.column(0)):
                keys, known = batch.column(1).slice(a, b - a).to_pylist(), pc.is_valid(batch.column(0).slice(a, b - a)).to_pylist()
                out = [t.bytes_of(i).decode() if known[i] else None for i in range(b - a)]
                if any(keys):
                    lost, w = covered(t, keys, window)
                    s, e, _ = t.spans()
                    for i in range(b - a):
                        if lost[w[i]:w[i + 1]].any():
                            out[i] = kept_text(t, s, e, lost, w[i], w[i + 1], i).decode()
                cols = {c: batch.column(2 + i).slice(a, b - a) for i, c in enumerate(rest)}
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text_col else cols[c] for c in names], names=names)

    return both.mapInArrow(run, docs.schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLE = {"op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks
         FROM (SELECT doc_id, unnest(range(i, i + 13)) AS k FROM g JOIN m USING (g) WHERE doc_id > low) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN ks IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(ks, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""}
