"""Exact byte-level dedup by column-wise construction of collection suffix structures.

A byte that lies in a `length`-byte string with another start anywhere (same document
included) goes. A suffix order of all texts does not fit one task, so the texts are dealt
by content: the smallest GRAM-byte fingerprint of a window of `length` bytes is its
anchor, and a run of windows with one anchor is a stretch of text. Equal windows have
equal anchors, so stretches of unlike anchors need not meet. Stretches are known by
anchor and digest first: an anchor with one place is done, equal stretches repeat each
other whole, and only unlike stretches of one anchor are compared. Their texts are
gathered by anchor, and of each bounded collection of them the Burrows-Wheeler transform
and the common prefixes are built column by column (scorebook.llm.collection); suffixes
with `length` common symbols are repeats.

An anchor with more than GROUP unlike stretches (a passage that very many documents
share) would make a collection without bound: the windows of its stretches are
fingerprinted one by one instead and meet in packed form (scorebook.llm.meeting), which
is exact up to 64-bit fingerprints and has no hot task.

Null and empty texts have no bytes. Repeated rows repeat each other, ids null or repeated
included: rows are told apart by doc_id and text, and rows alike in both are worked on as one, at a cost that grows with
their number. Texts beyond SEGMENT bytes are worked
on in overlapping segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.collection import shared_starts
from scorebook.llm.frames import packed_texts, partitions, per_batch, stage, table
from scorebook.llm.meeting import key_set, member, shared_keys
from scorebook.llm.words import BASE_INV, Texts, chunks, mix, packed_chunks, powers, prefix_sums

LENGTH, GRAM = 400, 128
GROUP = 64
SEGMENT = 4 << 20
COLLECTION_BYTES = 256 << 10
PLACE_BITS = 23  # SEGMENT + LENGTH fits


def _unpacked(col: pa.Array) -> Iterator[bytes]:
    for _, _, t in packed_chunks(col):
        yield from map(t.bytes_of, range(len(t)))


def _spans_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (sums[b] - sums[a]) * powers(BASE_INV, len(sums))[a]
        return mix(h + (b - a).astype(np.uint64), salt)


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w values in a row."""
    n = len(x) - w + 1
    pad = -len(x) % w
    blocks = np.append(x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def stretches(t: Texts, length: int, gram: int) -> Iterator[tuple]:
    """(text index, start, size, anchor, digest) arrays of the runs of windows with one anchor."""
    for i, base, buf, offs in _segments(t, length):
        if len(buf) < length:
            continue
        sums = prefix_sums(buf)
        at = np.arange(len(buf) - gram + 1)
        grams = _spans_hash(sums, at, at + gram, 3)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least = _sliding_least((grams & ~mask) | at.astype(np.uint64), length - gram + 1)
        ends = np.repeat(offs[1:], np.diff(offs))[:len(least)]
        text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(least)]
        ok = np.flatnonzero(np.arange(len(least)) + length <= ends)
        if not len(ok):
            continue
        place = (least[ok] & mask).astype(np.int64)
        cut = np.append(True, (place[1:] != place[:-1]) | (text[ok[1:]] != text[ok[:-1]]))
        first = np.flatnonzero(cut)
        start, last = ok[first], ok[np.append(first[1:], len(ok)) - 1]
        doc = text[start]
        yield (doc + i, start - offs[doc] + base, last + length - start, grams[place[first]],
               _spans_hash(sums, start, last + length, 4))


def _segments(t: Texts, length: int):
    """(first text, base, buffer, offsets): the texts at once, or a long text in overlapping segments."""
    if len(t.buf) <= SEGMENT:
        yield 0, 0, t.buf, t.offs
        return
    for i in range(len(t)):
        buf = t.buf[t.offs[i]:t.offs[i + 1]]
        for a in range(0, max(len(buf) - length + 1, 1), SEGMENT - length):
            part = buf[a:a + SEGMENT - 1]
            yield i, a, part, np.array([0, len(part)])


def _keyed(docs: DataFrame) -> DataFrame:
    """text, and id and key (xxhash64 of the text) that tell rows apart."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("id"),
                       F.xxhash64(text).alias("key"), text.alias("text"))


def repeated_spans(rows: DataFrame, packed: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   group: int = GROUP) -> DataFrame:
    """id, key, spans (array of first byte and size, each once, overlapping and unordered) of the rows (id, key, text); `packed`
    is their packed_texts."""
    n = partitions(rows.sparkSession)

    def cut(batch):
        ids, keys = batch.column(0), batch.column(1)
        for a, b, t in chunks(batch, "text"):
            for doc, start, size, anchor, digest in stretches(t, length, gram):
                at = pa.array(doc + a)
                yield {"id": ids.take(at), "key": keys.take(at), "start": start, "size": size,
                       "anchor": anchor.view(np.int64), "digest": digest.view(np.int64)}

    places = stage(per_batch(rows, cut, "id bigint, key bigint, start bigint, size bigint, anchor bigint, digest bigint"),
                   "places")
    # one row per unlike stretch, then what its anchor holds in all
    kinds = places.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "start", "size")).alias("at"))
    per = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("unlike"), F.sum("n").alias("total"),
                                      F.min("n").alias("fewest")).where("total > 1")
    kinds = stage(kinds.join(per, "anchor").select("anchor", "digest", "n", "at.*", "unlike", "fewest"), "kinds")
    whole = places.join(kinds.where("n > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi").select(
        "id", "key", F.struct("start", "size").alias("span"))
    # an anchor all of whose stretches repeat whole needs no comparing
    wanted = kinds.where("unlike > 1 and fewest = 1")
    lists = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("start", "size", "anchor", "digest", "n", "unlike")).alias("l"))
    cols = "id bigint, key bigint, start bigint, n bigint, unlike bigint, anchor bigint, part binary"

    def texts_of(batch):
        lists = batch.column(3)
        for i, text in enumerate(_unpacked(batch.column(2))):
            got = lists[i].as_py()
            yield {"id": [batch.column(0)[i].as_py()] * len(got), "key": [batch.column(1)[i].as_py()] * len(got),
                   "start": [x["start"] for x in got], "n": [x["n"] for x in got],
                   "unlike": [x["unlike"] for x in got], "anchor": [x["anchor"] for x in got],
                   "part": [text[x["start"]:x["start"] + x["size"]] for x in got]}

    held = packed.join(lists, ["id", "key"]).dropDuplicates(["id", "key"]).select("id", "key", "text", "l")
    parts = stage(per_batch(held, texts_of, cols), "stretches")

    def compare(batches):
        for strings, where in _collections(batches):
            for s, w, starts in zip(strings, where, shared_starts(strings, length)):
                if w[3] == 1 and len(starts):  # a stretch with several places goes whole anyway
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in w[:2]] + [
                        _span_list([_runs(starts, w[2], length)])], names=["id", "key", "spans"])

    span = "array<struct<start:bigint,size:bigint>>"
    few = (parts.where(F.col("unlike") <= group).repartition(n, "anchor").sortWithinPartitions("anchor")
           .mapInArrow(compare, f"id bigint, key bigint, spans {span}"))

    # stretches of crowded anchors: every window by itself
    crowded = parts.where(F.col("unlike") > group).select(F.xxhash64("id", "key", "start").alias("doc_id"), "part",
                                                           "id", "key", "start", "n")

    def emit(batch):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, t in chunks(batch, "part"):
            doc, _, h = _window_hashes(t, length)
            yield ids[a:b], doc, h, None

    shared = shared_keys(crowded, emit, exact=True, places=True)

    def locate(batch):
        keys = batch.column(4)
        for a, b, t in chunks(batch, "part"):
            doc, start, h = _window_hashes(t, length)
            cut = np.searchsorted(doc, np.arange(b - a + 1))
            spans = []
            for i in range(b - a):
                x, y = cut[i], cut[i + 1]
                hit = member(h[x:y], key_set(keys[a + i].as_py()))
                spans.append(_runs(start[x:y][hit], batch.column(3)[a + i].as_py(), length))
            yield {"id": batch.column(0).slice(a, b - a), "key": batch.column(1).slice(a, b - a),
                   "spans": _span_list(spans)}

    many = per_batch_spans(crowded.where("n = 1").join(shared, "doc_id").select("id", "key", "part", "start", "keys"),
                           locate)
    found = whole.union(few.union(many).select("id", "key", F.explode("spans").alias("span")))
    # a set: repeated rows bring the same spans, which meet here once each
    return found.groupBy("id", "key").agg(F.collect_set("span").alias("spans"))


def per_batch_spans(df: DataFrame, fn) -> DataFrame:
    def run(batches):
        for b in batches:
            for out in fn(b):
                yield pa.RecordBatch.from_arrays([out["id"], out["key"], out["spans"]], names=["id", "key", "spans"])

    return df.mapInArrow(run, "id bigint, key bigint, spans array<struct<start:bigint,size:bigint>>")


def _window_hashes(t: Texts, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, start and hash of every window of `length` bytes."""
    n = np.maximum(np.diff(t.offs) - length + 1, 0)
    doc = np.repeat(np.arange(len(t)), n)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    at = start + t.offs[doc]
    return doc, start, _spans_hash(prefix_sums(t.buf), at, at + length, 5) if len(doc) else np.zeros(0, np.uint64)


def _runs(starts: np.ndarray, base: int, length: int) -> list[dict]:
    """Byte spans that the windows at `starts` cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.append(True, np.diff(starts) > length))
    a, b = starts[cut], starts[np.append(cut[1:], len(starts)) - 1] + length
    return [{"start": int(x) + base, "size": int(y - x)} for x, y in zip(a, b)]


def _span_list(spans: list) -> pa.Array:
    return pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())])))


def _collections(batches):
    """Stretches, gathered to collections of whole anchors of about COLLECTION_BYTES."""
    strings, where, group, have, size = [], [], 0, None, 0
    for b in batches:
        cols = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
        anchors = cols["anchor"].to_pylist()
        info = list(zip(*(cols[c].to_pylist() for c in ("id", "key", "start", "n"))))
        for anchor, w, part in zip(anchors, info, cols["part"].to_pylist()):
            if anchor != have:
                have = anchor
                if size >= COLLECTION_BYTES:
                    yield strings, where
                    strings, where, size = [], [], 0
            strings.append(part)
            where.append(w)
            size += len(part)
    if strings:
        yield strings, where


def _gone(n: int, spans: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal removed runs."""
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = np.zeros(n + 1, np.int64)
    a = np.array([s["start"] for s in spans], np.int64)
    np.add.at(step, a, 1)
    np.add.at(step, a + np.array([s["size"] for s in spans], np.int64), -1)
    inside = np.concatenate([[0], (np.cumsum(step)[:-1] > 0).astype(np.int8), [0]])
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def with_spans(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, text (packed), spans of every row of `docs`."""
    rows = _keyed(docs)
    packed = packed_texts(rows)
    both = packed.join(repeated_spans(rows, packed, length, **options), ["id", "key"], "left")
    return both.select(F.when(F.col("id") != -(1 << 63), F.col("id")).alias("doc_id"), "text", "spans")


def suffix_report(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes) of every row of `docs`."""

    def run(batch):
        spans = batch.column(2)
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for i, text in enumerate(_unpacked(batch.column(1))):
            a, b = _gone(len(text), spans[i].as_py())
            kept = hashlib.sha256()
            for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]):
                kept.update(text[x:y])
            for c, v in zip(out, (len(text), int((b - a).sum()), len(a), kept.hexdigest())):
                out[c].append(v)
        yield {"doc_id": batch.column(0), **out}

    return per_batch(with_spans(docs, length, **options), run,
                     "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(table(spark, sf_dir, "documents"))


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLE: dict[str, str] = {}
