"""Interpolated modified Kneser-Ney bigram model, counted in Spark and kept as sorted hash arrays.

Counting: a map task packs the distinct bigrams of a batch of texts with their counts,
one row per bucket of the bigram hash; a bucket's task adds them up and writes one file:
the sorted bigram hashes and their counts. Buckets are ranges of the hash, so the files in
order are one sorted array. What a bucket knows of each word (count, distinct words before
it; as a context: how many bigrams occur once, twice, more often) is packed and added up
by ranges of the word hash in a second exchange, and kept the same way. Each batch and
bucket sends a word or bigram once, however frequent it is, so no word makes a hot task.

Scoring: workers memory-map the files and look up the distinct bigrams of some megabytes
of text at a time, in sorted order; nothing is shuffled, and no task holds the model. The
driver holds only the counts of counts.

    p(w | h) = max(c(hw) - D, 0) / c(h) + g(h) p(w),  p(w) = max(a(w) - d, 0) / A + g / (V + 1)

with a(w) the number of distinct words before w, and D, d the modified discounts for
counts of one, two, and three or more, from the counts of counts of each order. After an
unseen context the probability is p(w); an unseen word has g / (V + 1).

Words are 48-bit fingerprints, bigrams 64-bit ones. Null and empty texts have only the
end token. A null id counts as the empty text in the split, and repeated rows are texts of
their own. With no training text every probability is 1 / (V + 1) with V = 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.frames import partitions, per_batch, stage, table
from scorebook.llm.meeting import pack, unpack
from scorebook.llm.shared_files import map_arrays, write_arrays
from scorebook.llm.words import LOWER, chunks, mix
from scorebook.session import checkpoint_dir

FLUSH = 2_000_000
SUB_BUCKETS = 4
SCORE_BYTES = 2 << 20
MASK = np.uint64((1 << 48) - 1)
START, END = np.uint64(1), np.uint64(2)
STATS = ("c", "a", "n1", "n2", "n3")


def tokens(t) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token keys of all texts, the keys before them, and offsets per text: words, then the end."""
    h, w = t.mapped(LOWER).words(7)
    n = np.diff(w) + 1
    offs = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(offs[-1], np.uint64)
    last = np.zeros(len(out), bool)
    last[offs[1:] - 1] = True
    out[~last] = np.maximum(h & MASK, np.uint64(3))
    out[last] = END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[offs[:-1]] = START
    return out, before, offs


def bigram_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xC2B2AE3D27D4EB4F), 11)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Buckets are equal ranges of the upper 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _distinct(word, before, count=None):
    """Distinct bigrams in the order of their keys: keys, words, contexts, counts."""
    key = bigram_keys(before, word)
    order = np.argsort(key, kind="stable")
    k = key[order]
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    n = np.diff(np.append(start, len(k))) if count is None else np.add.reduceat(count[order], start) if len(k) else count
    first = order[start]
    return k[start], word[first], before[first], n


def _cut(buckets: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    edges = np.searchsorted(buckets, np.arange(n + 1))
    return [(int(b), int(edges[b]), int(edges[b + 1])) for b in np.flatnonzero(np.diff(edges))]


def _arrow(rows: list[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + 64]), kinds)], names=names)


def _by_bucket(batches) -> Iterator[tuple[int, list[bytes]]]:
    have, rows = None, []
    for b in batches:
        for k, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if rows and k != have:
                yield have, rows
                rows = []
            have = k
            rows.append(p)
    if rows:
        yield have, rows


def _dealt(df: DataFrame, n: int) -> DataFrame:
    """Rows (bucket, payload), each partition's buckets in order."""
    return (df.repartitionById(n, (F.col("bucket") % n).cast("int")).sortWithinPartitions("bucket")
            .select("bucket", "payload"))


def _spread_words(rows, n: int) -> Iterator[tuple]:
    """Packed word statistics (keys and STATS arrays), one row per bucket of the word hash."""
    key, stats = rows
    place = mix(key, 13)
    order = np.argsort(place, kind="stable")
    key, stats = key[order], [s[order] for s in stats]
    for b, x, y in _cut(bucket_of(place[order], n), n):
        yield b, pack(key[x:y], *[s[x:y] for s in stats])


def _tally(counts: np.ndarray) -> list[int]:
    """Counts of counts one to four, and of three or more."""
    return [int(np.count_nonzero(counts == i)) for i in (1, 2, 3, 4)] + [int(np.count_nonzero(counts >= 3))]


def train(texts: DataFrame) -> dict:
    """Counts the texts (a column `text`), writes the model's files, and returns their folder and the counts of counts."""
    spark = texts.sparkSession
    n = partitions(spark)
    buckets = n * SUB_BUCKETS
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-bigrams-{uuid.uuid4().hex}"

    def count(batches):
        have, size = [], 0

        def flush():
            key, word, before, c = _distinct(*(np.concatenate(x) for x in zip(*have)))
            out = []
            for b, x, y in _cut(bucket_of(key, buckets), buckets):
                by_word = np.argsort(word[x:y], kind="stable") + x
                u, size = np.unique(word[by_word], return_counts=True)
                out.append((b, pack(u, size, before[by_word], c[by_word])))
            return _arrow(out, ["bucket", "payload"], [pa.int32(), pa.binary()])

        for batch in batches:
            for _, _, t in chunks(batch):
                word, before, _ = tokens(t)
                have.append((word, before))
                size += len(word)
                if size >= FLUSH:
                    yield from flush()
                    have, size = [], 0
        if have:
            yield from flush()

    def add(batches):
        seen = []
        for b, rows in _by_bucket(batches):
            word, before, c = [], [], []
            for p in rows:
                u, size, h, k = unpack(p, np.uint64, np.int64, np.uint64, np.int64)
                word.append(np.repeat(u, size))
                before.append(h)
                c.append(k)
            key, word, before, c = _distinct(np.concatenate(word), np.concatenate(before), np.concatenate(c))
            write_arrays(folder + "/bigrams", f"{b:06d}", {"key": key, "c": c.astype(np.uint32 if c.max() < 1 << 32 else np.uint64)})
            u, back = np.unique(np.concatenate([word, before]), return_inverse=True)
            w, h = back[:len(word)], back[len(word):]
            m = len(u)
            add = lambda i, x: np.bincount(i, x, m).astype(np.int64)
            stats = [add(w, c), add(w, np.ones(len(c))), add(h, c == 1), add(h, c == 2), add(h, c >= 3)]
            if (u == START).any():  # the start is never predicted; its count as a context is the number of texts
                stats[0][u == START] = add(h, c)[u == START]
            seen.append((u, stats))
            yield from sent_rows([(b, 1, b"", _tally(c), int(c.sum()), len(c))])
        if seen:  # the words of all buckets of this task at once
            u, back = np.unique(np.concatenate([x for x, _ in seen]), return_inverse=True)
            stats = [np.bincount(back, np.concatenate([x[i] for _, x in seen]), len(u)).astype(np.int64) for i in range(5)]
            yield from sent_rows([(i, 0, p, [0] * 5, 0, 0) for i, p in _spread_words((u, stats), n)])

    def sent_rows(out):
        return _arrow(out, ["bucket", "kind", "payload", "tally", "total", "types"],
                      [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()])

    sent = texts.select("text").mapInArrow(count, "bucket int, payload binary")
    ddl = "bucket int, kind int, payload binary, tally array<bigint>, total bigint, types bigint"
    words = stage(_dealt(sent, n).mapInArrow(add, ddl), "words")

    def add_words(batches):
        for b, rows in _by_bucket(batches):
            parts = [unpack(p, np.uint64, *[np.int64] * 5) for p in rows]
            key = np.concatenate([p[0] for p in parts])
            u, back = np.unique(key, return_inverse=True)
            cols = [np.bincount(back, np.concatenate([p[1 + i] for p in parts]), len(u)).astype(np.uint64)
                    for i in range(5)]
            kinds = [np.uint32 if not len(x) or x.max() < 1 << 32 else np.uint64 for x in cols]
            write_arrays(folder + "/words", f"{b:06d}",
                         {"key": u, **{k: x.astype(t) for k, x, t in zip(STATS, cols, kinds)}})
            a = cols[1][cols[1] > 0]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([_tally(a)], pa.list_(pa.int64())),
                                              pa.array([len(a)], pa.int64()), pa.array([int(a.sum())], pa.int64())],
                                             names=["bucket", "tally", "types", "total"])

    one = _sums(words.where("kind = 1"))
    two = _sums(_dealt(words.where("kind = 0").select("bucket", "payload"), n)
                .mapInArrow(add_words, "bucket int, tally array<bigint>, types bigint, total bigint"))
    return {"folder": folder, "buckets": {"bigrams": buckets, "words": n}, "files": {"bigrams": one["files"], "words": two["files"]}, "tokens": one["total"], "words": two["types"], "pairs": two["total"],
            "bigram_discounts": discounts(one["tally"]), "word_discounts": discounts(two["tally"]), "word_tally": two["tally"]}


def _sums(rows: DataFrame) -> dict:
    """Totals of (bucket, tally, types, total) rows, added up in Spark, and the buckets that have a file."""
    got = rows.agg(F.collect_set("bucket").alias("files"), F.sum("types").alias("types"), F.sum("total").alias("total"),
                   *[F.sum(F.col("tally")[i]).alias(f"t{i}") for i in range(5)]).first()
    return {"files": set(got["files"]), "types": got["types"] or 0, "total": got["total"] or 0, "tally": [got[f"t{i}"] or 0 for i in range(5)]}


def discounts(tally: list[int]) -> list[float]:
    """The three modified discounts of Chen and Goodman; fixed ones where a count of counts is missing."""
    n1, n2, n3, n4, _ = tally
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.0), i + 1.0) for i, d in enumerate(raw)]


class Lookup:
    """A worker's view of the model's files."""

    def __init__(self, model: dict):
        self.m, self.files = model, {}

    def _file(self, kind: str, b: int):
        if (kind, b) not in self.files:
            self.files[kind, b] = map_arrays(f"{self.m['folder']}/{kind}", f"{b:06d}")
        return self.files[kind, b]

    def find(self, kind: str, keys: np.ndarray, place: np.ndarray, names: tuple) -> list[np.ndarray]:
        """Values of distinct keys, 0 where there are none; `place` (ascending) tells the bucket."""
        out = [np.zeros(len(keys), np.float64) for _ in names]
        for b, x, y in _cut(bucket_of(place, self.m["buckets"][kind]), self.m["buckets"][kind]):
            if b not in self.m["files"][kind]:  # no key was counted there; a file that should be there and is not raises
                continue
            f = self._file(kind, b)
            i = np.minimum(np.searchsorted(f["key"], keys[x:y]), len(f["key"]) - 1)
            hit = f["key"][i] == keys[x:y]
            for o, name in zip(out, names):
                o[x:y][hit] = f[name][i[hit]]
        return out

    def words(self, keys: np.ndarray) -> list[np.ndarray]:
        place = mix(keys, 13)
        order = np.argsort(place, kind="stable")
        got = self.find("words", keys[order], place[order], STATS)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return [g[back] for g in got]

    def log10s(self, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: log10 p(word | before), its count in the training tokens, log10 of the base probability."""
        m = self.m
        key = bigram_keys(before, word)
        u, first, back = np.unique(key, return_index=True, return_inverse=True)
        c_pair, = self.find("bigrams", u, u, ("c",))
        names, at = np.unique(np.concatenate([word[first], before[first]]), return_inverse=True)
        c, a, n1, n2, n3 = self.words(names)
        w, h = at[:len(u)], at[len(u):]
        d, e = (np.array([0.0, *x]) for x in (m["bigram_discounts"], m["word_discounts"]))
        off = lambda x, t: np.maximum(x - t[np.minimum(x, 3).astype(np.int64)], 0)
        t1, t2, _, _, t3 = m["word_tally"]
        pairs = max(m["pairs"], 1)
        rest = (e[1] * t1 + e[2] * t2 + e[3] * t3) / pairs if m["pairs"] else 1.0
        low = off(a, e) / pairs + rest / (m["words"] + 1)
        total = np.maximum(c[h], 1)
        weight = (d[1] * n1 + d[2] * n2 + d[3] * n3)[h] / total
        p = np.where(c[h] > 0, off(c_pair, d) / total + weight * low[w], low[w])
        known = np.where(names == START, 0, c)[w]
        base = np.log10((known + 0.1) / (m["tokens"] + 0.1 * (m["words"] + 1)))
        return np.log10(p)[back], known[back], base[back]


#: Per Python worker: folder -> lookup.
_WORKER: dict[str, Lookup] = {}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """id, held_out, n_tokens, n_known, base_score, score of every row (id, held_out, text)."""

    def run(batch):
        if model["folder"] not in _WORKER:
            _WORKER.clear()
            _WORKER[model["folder"]] = Lookup(model)
        look = _WORKER[model["folder"]]
        for x, y, t in chunks(batch, "text", SCORE_BYTES):
            word, before, offs = tokens(t)
            p, known, base = look.log10s(word, before)
            yield {"id": batch.column(0).slice(x, y - x), "held_out": batch.column(1).slice(x, y - x),
                   "n_tokens": np.diff(offs), "n_known": np.add.reduceat(known > 0, offs[:-1], dtype=np.int64),
                   "base_score": np.add.reduceat(base, offs[:-1]), "score": np.add.reduceat(p, offs[:-1])}

    return per_batch(docs.select("id", "held_out", "text"), run, "id bigint, held_out boolean, n_tokens bigint, "
                                                                 "n_known bigint, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def language_model_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of `docs` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    model = train(rows.where("not held_out"))
    return score(rows, model).select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(model["tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op7_language_model": op7_language_model}
ORACLE: dict[str, str] = {}
