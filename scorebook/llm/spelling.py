"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the form each belongs to.

Words are counted over all whole texts (see `word_counts`). The near words of a word are found by a trie over
letter-group counts: the letters are dealt into GROUPS groups, balanced by how often they occur in the words, and
a word is the vector of its counts per group. One edit adds at most one letter to one group (surplus) and takes at
most one from another (deficit), so a search carries a budget of one of each down the trie, one group a level, and
verifies the words at the leaves it reaches letter by letter.

The first levels and the word's length are the key of an exchange: a word is stored under its own key and sent, as a
query, to the keys its budget allows. Below a key the tries are built and searched inside tasks, each with what is
left of the budget. How many levels belong to the key follows from the number of words, so that the words of one key
stay few. A pair is met once: from its longer word, or at equal length from the smaller key (then word).

Null and empty texts have no words; a null id counts as the empty string where runs are hashed. Repeated rows count
again. Runs of any length are taken whole. Of several near words with the largest n the smallest in code-point order
is the form. Extra columns are left out, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.frames import keyed_texts, partitions, stage, table
from scorebook.llm.words import LOWER, Texts, chunks, ragged

MIN_LETTERS, MIN_COUNT, FORM_RATIO, EDIT_EVERY = 7, 2, 10, 31
GROUPS, KEY_LEVELS, WORDS_PER_KEY = 14, (2, 6), 10_000
TOP = 63  # counts above it are one (a letter more or less then spends nothing)
HELD_WORDS, BLOCK, PAIR_BYTES, LONG_RUN = 300_000, 4096, 1 << 24, 64

_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t.astype(np.uint32)


_CRC = _crc_table()


def letter_runs(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of maximal runs of A-Z, a-z and U+00C0 to U+00FF (lead byte C3) within a text."""
    if not len(t.buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lead = t.buf == 0xC3
    on = _ASCII[t.buf] | lead
    on[1:] |= lead[:-1]
    first, last = on.copy(), on.copy()
    first[1:] &= ~on[:-1]
    last[:-1] &= ~on[1:]
    edge = t.offs[1:-1]
    edge = edge[(edge > 0) & (edge < len(on))]
    first[edge] |= on[edge]
    last[edge - 1] |= on[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def crc32_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """crc32 of a prefix (given by its crc32) followed by a span of the buffer."""
    lens = ends - starts
    order = np.argsort(-lens, kind="stable")
    at, left = starts[order], lens[order]
    reg = (prefix[order] ^ np.uint32(0xFFFFFFFF)).astype(np.uint32)
    for j in range(min(int(left[0]) if len(left) else 0, LONG_RUN)):
        k = int(np.searchsorted(-left, -j, side="left"))  # spans longer than j
        reg[:k] = _CRC[(reg[:k] ^ buf[at[:k] + j]) & np.uint32(255)] ^ (reg[:k] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = reg ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lens > LONG_RUN):
        out[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(prefix[i]))
    return out


def chunk_words(t: Texts, ids: list) -> pa.Array:
    """The words of some texts, by the rule of `word_counts`, with repetitions."""
    starts, ends = letter_runs(t)
    t = t.mapped(LOWER)
    head = np.concatenate([[0], np.cumsum((t.buf & 0xC0) != 0x80)])
    letters = head[ends] - head[starts]
    some = letters >= MIN_LETTERS
    starts, ends, letters = starts[some], ends[some], letters[some]
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = crc32_spans(t.buf, starts, ends, prefix[np.searchsorted(t.offs, starts, side="right") - 1])
    edited = h % EDIT_EVERY == 0
    lens = (ends - starts)[~edited]
    offs = np.concatenate([[0], np.cumsum(lens)])
    data = t.buf[ragged(starts[~edited], lens)]
    whole = pa.Array.from_buffers(pa.large_string(), len(lens), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(data))])
    short = []
    for i in np.flatnonzero(edited & (letters > MIN_LETTERS)):
        s = t.buf[starts[i]:ends[i]].tobytes().decode()
        k = int(h[i]) % len(s)
        short.append(s[:k] + s[k + 1:])
    return pa.concat_arrays([whole, pa.array(short, pa.large_string())])


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of every word that occurs at least MIN_COUNT times in `docs` (doc_id, text).

    A word is a maximal run of letters, A-Z in lower case. Of a run whose crc32, with the document's id before it,
    EDIT_EVERY divides, one code point is deleted. Results of at least MIN_LETTERS code points count."""

    def run(batches):
        held, rows = [], 0

        def merged():
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, t in chunks(batch):
                found = pc.value_counts(chunk_words(t, ids[a:b]))
                if len(found):
                    held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                    rows += len(found)
                if rows > 2 * HELD_WORDS:
                    held = [merged()]
                    rows = held[0].num_rows
                    if rows > HELD_WORDS:
                        yield from _out(held[0])
                        held, rows = [], 0
        if held:
            yield from _out(merged())

    counted = keyed_texts(docs).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _out(t: pa.Table):
    yield from t.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(max_chunksize=20_000)


def letter_groups(words: DataFrame) -> np.ndarray:
    """For each letter (as a Latin-1 byte) its group: the most frequent letters first, each to the lightest group.

    At most 90 letters exist, so their counts are a small result."""
    seen = (words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect())
    load, out = [0] * GROUPS, np.zeros(256, np.int64)
    for r in sorted(seen, key=lambda r: (-r["count"], r["c"])):
        g = load.index(min(load))
        out[ord(r["c"])] = g
        load[g] += r["count"]
    return out


def latin(t: Texts) -> Texts:
    """Words (code points up to U+00FF) with a byte per code point."""
    lead = t.buf == 0xC3
    letters = np.where(t.buf >= 0x80, t.buf + np.uint8(0x40), t.buf)[~lead]
    return Texts(letters, np.concatenate([[0], np.cumsum(~lead)])[t.offs])


def as_strings(t: Texts) -> pa.Array:
    """The inverse of `latin`."""
    wide = t.buf >= 0x80
    ends = np.cumsum(1 + wide)
    out = np.repeat(t.buf, 1 + wide)
    out[ends[wide] - 2] = 0xC3
    out[ends[wide] - 1] -= np.uint8(0x40)
    offs = np.concatenate([[0], ends])[t.offs].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(t), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(out))])


def _vectors(t: Texts, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts per group (at most TOP) and lengths of some words."""
    lens = np.diff(t.offs)
    owner = np.repeat(np.arange(len(t)), lens)
    counts = np.bincount(owner * GROUPS + group[t.buf], minlength=len(t) * GROUPS).reshape(-1, GROUPS)
    return np.minimum(counts, TOP), lens


def _key(counts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    key = lens.astype(np.int64)
    for j in range(counts.shape[1]):
        key = (key << 6) | counts[:, j]
    return key


def key_rows(words: DataFrame, group: np.ndarray, levels: int) -> DataFrame:
    """key, query, word (a byte per letter), n: every word under its own key (query 0), and as a query (1) under each
    key that its budget allows, if it is the one of a pair that asks there."""
    unit, none = np.eye(levels, dtype=np.int64), np.zeros(levels, np.int64)
    moves = [(-down, -1) for down in (none, *unit)] + [
        (up - down, 0) for i, up in enumerate((none, *unit)) for j, down in enumerate((none, *unit)) if i != j or not i]

    def run(batches):
        for batch in batches:
            t, n = latin(Texts.of(batch.column(0))), batch.column(1).to_numpy()
            counts, lens = _vectors(t, group)
            c = counts[:, :levels]
            own = _key(c, lens)
            at, keys = [np.arange(len(own))], [own]
            for move, longer in moves:
                to = c + move
                ok = ((to >= 0) & (to <= TOP)).all(1)
                k = _key(np.clip(to, 0, TOP), lens + longer)
                if not longer:
                    ok &= k >= own
                at.append(np.flatnonzero(ok))
                keys.append(k[ok])
            first, at, keys = len(own), np.concatenate(at), np.concatenate(keys)
            for x in range(0, len(at), 10_000):
                rows = at[x:x + 10_000]
                some = t.take(rows)
                data = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(some.offs.astype(np.int32)),
                                                                     pa.py_buffer(np.ascontiguousarray(some.buf))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[x:x + 10_000]), pa.array((np.arange(x, x + len(rows)) >= first).astype(np.int32)), data,
                     pa.array(n[rows])], names=["key", "query", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key bigint, query int, word binary, n bigint")


class CountTrie:
    """The words of one key (all of one length) by their counts in the groups below the key's."""

    def __init__(self, words: Texts, n: np.ndarray, group: np.ndarray, levels: int):
        self.words, self.n, self.group, self.levels = words, n, group, levels
        counts, lens = _vectors(words, group)
        self.head, rest, self.length = counts[0, :levels], counts[:, levels:], int(lens[0])
        self.letters = words.buf.reshape(len(words), self.length)
        node, self.steps = np.zeros(len(words), np.int64), []
        for j in range(rest.shape[1]):  # a level's children, by (parent, count)
            keys, node = np.unique(node << 6 | rest[:, j], return_inverse=True)
            self.steps.append(keys)
        self.order = np.argsort(node, kind="stable")
        self.leaf = np.searchsorted(node[self.order], np.arange(len(self.steps[-1]) + 1))

    def search(self, words: Texts):
        """Number of the query, number of the word of the near pairs: depth first over blocks of open branches."""
        counts, lens = _vectors(words, self.group)
        head, rest = counts[:, :self.levels], counts[:, self.levels:]
        plus = 1 - np.maximum(self.head - head, 0).sum(1)
        minus = 1 - np.maximum(head - self.head, 0).sum(1)
        ok = np.flatnonzero((plus >= 0) & (minus >= 0))
        letters = np.zeros((len(words), self.length + 1), np.uint8)
        for size in (self.length, self.length + 1):
            letters[lens == size, :size] = words.buf[words.offs[:-1][lens == size][:, None] + np.arange(size)]
        both = (head == self.head).all(1) & (lens == self.length)  # then two words of a pair ask: the smaller is heard
        stack = [(0, q, np.zeros(len(q), np.int64), plus[q], minus[q]) for q in (ok[x:x + BLOCK] for x in range(0, len(ok), BLOCK))]
        while stack:
            level, q, node, up, down = stack.pop()
            if level == len(self.steps):
                yield from self._verified(q, node, letters, lens > self.length, both)
                continue
            have, keys = rest[q, level], self.steps[level]
            found = []
            for move, can in ((0, None), (1, up > 0), (-1, down > 0)):
                rows = np.arange(len(q)) if can is None else np.flatnonzero(can)
                want = have[rows] + move
                rows, want = rows[(want >= 0) & (want <= TOP)], want[(want >= 0) & (want <= TOP)]
                key = node[rows] << 6 | want
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                found.append((q[rows[hit]], at[hit], up[rows[hit]] - (move > 0), down[rows[hit]] - (move < 0)))
            q, node, up, down = (np.concatenate(x) for x in zip(*found))
            for x in range(0, len(q), 4 * BLOCK):
                stack.append((level + 1, *(v[x:x + 4 * BLOCK] for v in (q, node, up, down))))

    def _verified(self, q, node, letters, longer, both):
        size = self.leaf[node + 1] - self.leaf[node]
        a, b = np.repeat(q, size), self.order[ragged(self.leaf[node], size)]
        step = max(1, PAIR_BYTES // (self.length + 1))
        for i in range(0, len(a), step):
            u, v = a[i:i + step], b[i:i + step]
            left, right = letters[u], self.letters[v]
            same = left[:, :-1] == right
            near = ~longer[u] & (same.sum(1) == self.length - 1)
            rows = np.flatnonzero(longer[u])
            ahead = np.logical_and.accumulate(same[rows], axis=1).sum(1)
            behind = np.logical_and.accumulate((left[rows, 1:] == right[rows])[:, ::-1], axis=1).sum(1)
            near[rows] = ahead + behind >= self.length
            u, v = u[near], v[near]
            first = (letters[u][:, :-1] != self.letters[v]).argmax(1) if len(u) else u
            once = ~both[u] | (letters[u, first] < self.letters[v, first])
            yield u[once], v[once]


def near_words(words: DataFrame, group: np.ndarray, levels: int) -> DataFrame:
    """word, near, near_n: every near pair of `words` (word, n), in both directions."""
    rows = key_rows(words, group, levels)
    dealt = rows.repartition(partitions(words.sparkSession), "key").sortWithinPartitions("key", "query")

    def joined(parts):
        lens = np.concatenate([np.diff(t.offs) for t, _ in parts])
        return (Texts(np.concatenate([t.buf for t, _ in parts]), np.concatenate([[0], np.cumsum(lens)])),
                np.concatenate([n for _, n in parts]))

    def found(trie, asks):
        t, n = joined(asks)
        for q, w in trie.search(t):
            for i in range(0, len(q), 10_000):
                a, b = q[i:i + 10_000], w[i:i + 10_000]
                x, y = as_strings(t.take(a)), as_strings(trie.words.take(b))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]), pa.concat_arrays([y, x]),
                                                  pa.array(np.concatenate([trie.n[b], n[a]]))], names=["word", "near", "near_n"])

    def run(batches):
        now, trie, stored, asks = None, None, [], []
        for batch in batches:
            key, query, n = (batch.column(i).to_numpy() for i in (0, 1, 3))
            t = Texts.of(batch.column(2))
            cut = (np.flatnonzero(np.diff(key) | np.diff(query)) + 1).tolist()
            for a, b in zip([0, *cut], [*cut, len(key)]):
                if key[a] != now:
                    if asks:
                        yield from found(trie, asks)
                    now, trie, stored, asks = key[a], None, [], []
                if not query[a]:
                    stored.append((t.slice(a, b), n[a:b]))
                elif stored:
                    trie = trie or CountTrie(*joined(stored), group, levels)
                    asks.append((t.slice(a, b), n[a:b]))
                    if sum(len(x) for x, _ in asks) >= 4 * BLOCK:
                        yield from found(trie, asks)
                        asks = []
        if asks:
            yield from found(trie, asks)

    return dealt.mapInArrow(run, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every word with a form, by pointer doubling; a form has FORM_RATIO times the n, so chains are
    short and end."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        far = now.join(step, "root", "left")
        if far.where(F.col("further").isNotNull()).isEmpty():
            return now
        now = stage(far.select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words of `docs` (doc_id, text)."""
    words = stage(word_counts(docs), "words")
    size = words.count()
    levels = KEY_LEVELS[0]
    while levels < KEY_LEVELS[1] and size > WORDS_PER_KEY * 8 * 2 ** levels:  # a level splits the words of a key about in two
        levels += 1
    pairs = near_words(words, letter_groups(words), levels)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = stage(best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")), "near")
    fits = F.col("near_n") >= FORM_RATIO * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n"))
    judged = stage(judged, "judged")
    last = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLE: dict[str, str] = {}
