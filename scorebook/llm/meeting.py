"""Which fingerprints do several places of a corpus share?

A fingerprint per word or byte of 100 TB cannot travel as a row of its own. Here a map
task packs the distinct fingerprints of a batch of documents into one row per bucket of
the fingerprint space (sorted, delta-coded), a bucket's task merges what all batches sent
and answers each batch with the shared ones, and the answers are regrouped by document.

Nothing grows with one hot fingerprint: a batch sends it once, whatever the number of
its documents that hold it (the lists of those documents go by batch, not by
fingerprint). The number of buckets follows spark.sql.shuffle.partitions, so that a
bucket's share is set by the cluster as for any shuffle; a task works through its
buckets one after the other.

Fingerprints are cut to 39 bits beside the bucket number where they only select
candidates (`exact=False`), else all 64 bits travel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.frames import partitions
from scorebook.llm.words import ragged

FLUSH = 2_000_000
BATCH_DOCS = 60_000
SUB_BUCKETS = 4
REST = (1 << 39) - 1

PROBE, LOCAL, DOCS = 0, 1, 2
ROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()),
                 ("payload", pa.binary())])
DDL = "part int, bucket int, batch bigint, kind int, payload binary"


def codes(h: np.ndarray, buckets: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and key of each fingerprint."""
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), h if exact else h & np.uint64(REST)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes (the high bytes of small numbers cost almost nothing)."""
    head = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64)
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in arrays]
    return zstandard.ZstdCompressor(1).compress(b"".join([head.tobytes(), *planes]))


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8)
    out, at = [], 8 * (n + 1)
    for size, kind in zip(sizes.tolist(), kinds):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, size, at).reshape(wide, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size
    return out


def _pack_sorted(keys: np.ndarray) -> list[np.ndarray]:
    """Ascending distinct keys: the first, and the steps in four bytes if they fit."""
    steps = np.diff(keys)
    narrow = not len(steps) or int(steps.max()) < 1 << 32
    return [keys[:1], steps.astype(np.uint32) if narrow else np.zeros(0, np.uint32),
            np.zeros(0, np.uint64) if narrow else steps]


def _unpack_sorted(first: np.ndarray, narrow: np.ndarray, wide: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([first, narrow.astype(np.uint64), wide]), dtype=np.uint64)


class Batch:
    """Fingerprints of some documents until they are sent."""

    def __init__(self, n_parts: int, exact: bool, places: bool):
        self.n_parts, self.exact, self.places = n_parts, exact, places
        self.clear()

    def clear(self):
        self.ids, self.h, self.doc, self.flag, self.n = [], [], [], [], 0

    def add(self, ids: np.ndarray, doc: np.ndarray, h: np.ndarray, flag: np.ndarray | None):
        base = sum(map(len, self.ids))
        held = np.bincount(doc, minlength=len(ids)) > 0  # documents without fingerprints stay out
        ids, doc = ids[held], (np.cumsum(held) - 1)[doc]
        self.ids.append(ids)
        self.h.append(h)
        self.doc.append((doc + base).astype(np.uint32))
        self.flag.append(np.ones(len(h), bool) if flag is None else flag)
        self.n += len(h)
        return self.n >= FLUSH or base + len(ids) >= BATCH_DOCS

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            self.clear()
            return
        ids = np.concatenate(self.ids)
        h, doc, flag = (np.concatenate(x) for x in (self.h, self.doc, self.flag))
        self.clear()
        rank = np.argsort(ids, kind="stable")  # documents by id
        ids, at = ids[rank], np.empty(len(rank), np.uint32)
        at[rank] = np.arange(len(rank), dtype=np.uint32)
        doc = at[doc]
        n_buckets = self.n_parts * SUB_BUCKETS
        bucket, key = codes(h, n_buckets, self.exact)
        del h
        order = np.lexsort((doc, key, bucket)) if self.exact else \
            np.argsort((bucket.astype(np.uint64) << np.uint64(39)) | key, kind="stable")
        bucket, key, doc, flag = bucket[order], key[order], doc[order], flag[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        first = np.minimum.reduceat(doc, start)
        many = size > 1 if self.places else np.maximum.reduceat(doc, start) > first
        marked = np.logical_or.reduceat(flag, start)
        batch = (int(ids[0]) * 0x9E3779B97F4A7C15 + int(np.bitwise_xor.reduce(key)) + len(key)) % (1 << 62)
        b_of, k_of = bucket[start], key[start]
        edges = np.searchsorted(b_of, np.arange(n_buckets + 1))
        out = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            x, y = edges[b], edges[b + 1]
            who = ids[first[x:y]] if self.exact else first[x:y]
            out.append((b % self.n_parts, b, batch, PROBE, pack(
                *_pack_sorted(k_of[x:y]), who, np.packbits(marked[x:y]), np.packbits(many[x:y]))))
        home = batch % self.n_parts
        local = np.flatnonzero(many)
        if len(local):
            out.append((home, -1, batch, LOCAL, pack(
                b_of[local].astype(np.int32), k_of[local], size[local].astype(np.uint32),
                doc[ragged(start[local], size[local])])))
        out.append((home, -1, batch, DOCS, pack(ids)))
        for i in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[i:i + 64]), ROW)], schema=ROW)


def _groups(batches, column: str):
    """Rows of a sorted stream, gathered by one column: (value, [(batch, kind, payload)])."""
    have, rows = None, []
    for b in batches:
        key, batch, kind, payload = (b.column(b.schema.get_field_index(c)) for c in (column, "batch", "kind", "payload"))
        for k, x, y, p in zip(key.to_pylist(), batch.to_pylist(), kind.to_pylist(), payload):
            if rows and k != have:
                yield have, rows
                rows = []
            have = k
            rows.append((x, y, p.as_py()))
    if rows:
        yield have, rows


def _merge(rows, exact: bool, earlier: bool) -> Iterator[tuple[int, bytes]]:
    """One bucket: the answers to each batch, the keys that are shared."""
    parts, who_kind = [], np.int64 if exact else np.uint32
    for _, _, data in rows:
        f, a, w, who, marked, many = unpack(data, np.uint64, np.uint32, np.uint64, who_kind, np.uint8, np.uint8)
        key = _unpack_sorted(f, a, w)
        parts.append((key, who, np.unpackbits(marked, count=len(key)).astype(bool),
                      np.unpackbits(many, count=len(key)).astype(bool)))
    key, who, marked, many = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    shared = (np.diff(np.append(start, len(k))) > 1) | np.logical_or.reduceat(many[order], start)
    shared &= np.logical_or.reduceat(marked[order], start)
    keep = np.empty(len(k), bool)
    keep[order] = shared[group]
    lowest = np.zeros(0, np.int64)
    if earlier:
        lowest = np.empty(len(k), np.int64)
        lowest[order] = np.minimum.reduceat(who[order], start)[group]
        keep &= many | (who > lowest)
    at = 0
    for (batch, _, _), p in zip(rows, parts):
        mine = at + np.flatnonzero(keep[at:at + len(p[0])])
        at += len(p[0])
        if len(mine):
            yield batch, pack(key[mine], who[mine], np.packbits(many[mine]), lowest[mine[many[mine]]] if earlier else lowest)


def _by_document(rows, exact: bool, earlier: bool) -> Iterator[tuple[int, np.ndarray]]:
    """One batch: (doc_id, codes) of its documents that hold shared keys."""
    ids = unpack(next(p for _, kind, p in rows if kind == DOCS), np.int64)[0]
    local: dict = {}
    for _, kind, p in rows:
        if kind == LOCAL:
            b, k, size, doc = unpack(p, np.int32, np.uint64, np.uint32, np.uint32)
            local = {"b": b, "k": k, "end": np.cumsum(size, dtype=np.int64), "size": size.astype(np.int64), "doc": doc}
    docs, found = [], []
    for bucket, kind, p in rows:
        if kind != PROBE:
            continue
        b = int(np.frombuffer(p[:8], np.int64)[0])
        k, who, many, lowest = unpack(p[8:], np.uint64, np.int64 if exact else np.uint32, np.uint8, np.int64)
        many = np.unpackbits(many, count=len(k)).astype(bool)
        docs.append(who[~many] if exact else ids[who[~many]])
        found.append(_codes(b, k[~many], exact))
        if many.any():
            x, y = np.searchsorted(local["b"], [b, b + 1])
            i = x + np.searchsorted(local["k"][x:y], k[many])
            n = local["size"][i]
            doc = ids[local["doc"][ragged(local["end"][i] - n, n)]]
            code = np.repeat(_codes(b, k[many], exact), n)
            if earlier:
                later = doc > np.repeat(lowest, n)
                doc, code = doc[later], code[later]
            docs.append(doc)
            found.append(code)
    if not docs:
        return
    doc, code = np.concatenate(docs), np.concatenate(found)
    order = np.argsort(doc, kind="stable")
    doc, code = doc[order], code[order]
    cut = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    for a, z in zip(cut, [*cut[1:], len(doc)]):
        yield int(doc[a]), code[a:z]


def _codes(bucket: int, keys: np.ndarray, exact: bool) -> np.ndarray:
    return keys if exact else np.uint64(bucket << 39) | keys


def shared_keys(df: DataFrame, emit: Callable, exact: bool, places: bool = False, earlier: bool = False) -> DataFrame:
    """doc_id, keys: per document, its fingerprints that are shared.

    `emit(record_batch)` yields (ids int64 per document, document index per fingerprint,
    fingerprints uint64, flags or None). A fingerprint is shared if two documents hold it
    (`places`: if it has two places, in one document or several) and at least one of its
    flags is set. `earlier` (with `exact`): only for documents with a larger id than the
    smallest that holds it. `keys` is binary (see `key_set`), one row per document.
    """
    if earlier and not exact:
        raise ValueError("earlier needs exact fingerprints")
    n = partitions(df.sparkSession)

    def probe(batches):
        mine = Batch(n, exact, places)
        for b in batches:
            for part in emit(b):
                if mine.add(*part):
                    yield from mine.rows()
        yield from mine.rows()

    def answer(batches):
        out = []
        for bucket, rows in _groups(batches, "bucket"):
            if bucket < 0:
                out += rows
            else:
                head = np.array([bucket], np.int64).tobytes()
                out += [(batch, PROBE, head + p) for batch, p in _merge(rows, exact, earlier)]
            if out:
                yield _rows(out)
                out = []

    def _rows(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
             pa.array([x[2] for x in out], pa.binary())], names=["batch", "kind", "payload"])

    def regroup(batches):
        for _, rows in _groups(batches, "batch"):
            got = [(d, code.tobytes()) for d, code in _by_document(rows, exact, earlier)]
            for i in range(0, len(got), 1000):
                part = got[i:i + 1000]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int64()),
                                                  pa.array([x[1] for x in part], pa.binary())], names=["doc_id", "keys"])

    sent = df.mapInArrow(probe, DDL).repartitionById(n, F.col("part")).sortWithinPartitions("bucket")
    answers = sent.select("bucket", "batch", "kind", "payload").mapInArrow(answer, "batch bigint, kind int, payload binary")
    back = answers.repartition(n, "batch").sortWithinPartitions("batch")
    found = back.mapInArrow(regroup, "doc_id bigint, keys binary")
    # repeated rows of one id may have gone in several batches
    return found.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))


def key_set(parts: list[bytes]) -> np.ndarray:
    """Sorted distinct codes of the answers to one document, comparable with `own_codes`."""
    return np.unique(np.frombuffer(b"".join(parts), np.uint64))


def own_codes(h: np.ndarray, n_parts: int, exact: bool) -> np.ndarray:
    if exact:
        return h
    b, k = codes(h, n_parts * SUB_BUCKETS, False)
    return (b.astype(np.uint64) << np.uint64(39)) | k


def member(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each element of h is in the sorted keys."""
    if not len(keys):
        return np.zeros(len(h), bool)
    i = np.searchsorted(keys, h)
    i[i == len(keys)] = 0
    return keys[i] == h
