"""Near-duplicate documents by HyperMinHash sketches.

A document's set is its distinct word shingles (64-bit fingerprints). Its sketch has
BUCKETS registers of 16 bits: per bucket of the fingerprint space, the leading-zero count
(6 bits) and the next MANTISSA bits of the smallest fingerprint. Documents with equal sets
are one class, kept by its smallest id. Bands of ROWS registers of each class are joined
(for a band, an empty register takes the value of the first filled one in a fixed order of
its own, so that small sets, too, agree in a band only as often as they are similar);
candidate pairs must pass the exact size test and the collision-corrected Jaccard
estimate less MARGIN standard deviations, and are then confirmed on the full sets.

A large group's pairs are not listed. In a band's group each member is paired with the
smallest member. Where that leaves several components, the members outside the largest are
paired with PIVOTS of its members, drawn anew in every band and round, so a document in
many bands meets many of those it resembles. What is then still apart is compared with all
members of other components in its groups, whatever their number, but in blocks of BLOCK
members inside tasks, on samples of the sets (a whole set up to 2 * SAMPLE shingles), once
per pair; only what passes comes out and is confirmed. So no link that the bands find is
lost. At a similarity of 0.75 the bands miss a pair with a chance of (1 - 0.75**3)**42 =
1e-10.

Null and empty texts have an empty set and are linked with nothing. Rows that share an id
are judged by their own text; null ids take no part in links and are their own component
(null). Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.frames import free_name, keyed_texts, packed_texts, partitions, per_batch, stage, table, without_numbers
from scorebook.llm.graph import components
from scorebook.llm.words import LOWER, Texts, chunks, packed_chunks, windows

SHINGLE, PERCENT = 5, 75
BUCKET_BITS, MANTISSA, ROWS = 7, 10, 3
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // ROWS
BLOCK, SAMPLE = 1024, 256
MARGIN, PIVOT_ROUNDS, PIVOTS = 6.0, 1, 3
#: Fixed value: expected share of equal registers of unlike sets, times 2**mantissa bits.
COLLISION = 0.169919487159739


def shingle_sets(t: Texts, size: int = SHINGLE) -> list[np.ndarray]:
    """Per text, the sorted distinct fingerprints of its shingles (fewer words: one of them all)."""
    h, w = t.mapped(LOWER).words()
    pos, g = windows(h, w, size)
    cut = np.searchsorted(pos, w)
    out = []
    for i in range(len(t)):
        n = w[i + 1] - w[i]
        if n >= size:
            out.append(np.unique(g[cut[i]:cut[i + 1]]))
        else:
            own = h[w[i]:w[i + 1]]
            out.append(windows(own, np.array([0, n]), int(n), int(n))[1] if n else own)
    return out


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers, one row per set; 0 is an empty bucket."""
    low, used = np.zeros((len(sets), BUCKETS), np.uint64), np.zeros((len(sets), BUCKETS), bool)
    for i, u in enumerate(sets):
        b, at = np.unique(u >> np.uint64(64 - BUCKET_BITS), return_index=True)  # ascending: the first is the least
        low[i, b.astype(np.int64)] = u[at] << np.uint64(BUCKET_BITS)
        used[i, b.astype(np.int64)] = True
    zeros = 53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)
    zeros = np.clip(zeros, 0, 53)
    mantissa = (low << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    return np.where(used, ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA)) | mantissa, 0).astype(np.uint16)


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers with each empty one taken from the first filled one of its own probing order."""
    out, rng = regs.copy(), np.random.default_rng(BUCKETS)
    row, col = np.nonzero((out == 0) & (regs > 0).any(1).all())
    while len(row):  # only those that are still empty are looked at again
        taken = regs[row, rng.integers(0, BUCKETS, BUCKETS)[col]]
        out[row, col] = taken
        row, col = row[taken == 0], col[taken == 0]
    return out


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), registers; digest and registers are null for empty sets."""

    def run(batch):
        for a, b, t in chunks(batch):
            sets = shingle_sets(t, size)
            regs = sketch(sets)
            some = [len(u) > 0 for u in sets]
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_shingles": [len(u) for u in sets],
                   "digest": [xxhash.xxh3_128_digest(u.tobytes()) if s else None for u, s in zip(sets, some)],
                   "registers": [r.tobytes() if s else None for r, s in zip(regs, some)]}

    return per_batch(keyed_texts(docs), run, "doc_id bigint, n_shingles bigint, digest binary, registers binary")


def _band_rows(classes: DataFrame) -> DataFrame:
    """band, node: the bands of each class."""
    number = np.arange(BANDS, dtype=np.int64) << 48

    def run(batch):
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        regs = Texts.of(batch.column(2)).buf.view(np.uint16).reshape(-1, BUCKETS)
        r = filled(regs)[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.int64)
        key = (r[:, :, 0] << 32) | (r[:, :, 1] << 16) | r[:, :, 2]
        yield {"band": (key | number).ravel(), "node": np.repeat(nodes, BANDS)}

    return per_batch(classes.select("node", "n", "registers"), run, "band bigint, node bigint")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the sizes and the sketches allow."""
    a = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    b = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    both = pairs.join(a, "a").join(b, "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "na", "nb", "ra", "rb")

    def run(batch):
        na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3))
        ra, rb = (Texts.of(batch.column(i)).buf.view(np.uint16).reshape(-1, BUCKETS) for i in (4, 5))
        filled = np.maximum(((ra > 0) | (rb > 0)).sum(1), 1)
        chance = COLLISION * BUCKETS / (1 << MANTISSA) * 4 * na * nb / np.maximum(na + nb, 1) ** 2
        share = (((ra == rb) & (ra > 0)).sum(1) - chance) / filled
        p = percent / 100
        keep = np.flatnonzero(share >= p - MARGIN * np.sqrt(p * (1 - p) / filled))
        yield {"a": batch.column(0).take(pa.array(keep)), "b": batch.column(1).take(pa.array(keep))}

    return per_batch(both, run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batch):
        sa, sb = Texts.of(batch.column(2)), Texts.of(batch.column(3))
        keep = []
        for i in range(batch.num_rows):
            x = sa.buf[sa.offs[i]:sa.offs[i + 1]].view(np.uint64)
            y = sb.buf[sb.offs[i]:sb.offs[i + 1]].view(np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                keep.append(i)
        rows = pa.array(keep, pa.int64())
        yield {"a": batch.column(0).take(rows), "b": batch.column(1).take(rows)}

    return per_batch(both, run, "a bigint, b bigint")


def _sampled(shingles: np.ndarray) -> tuple[int, np.ndarray]:
    """The fingerprints of a set below 2**(64 - level), SAMPLE to 2 * SAMPLE of them; all (level 0) of a small set."""
    level = max(0, (len(shingles) // SAMPLE).bit_length() - 1)
    return level, shingles[:np.searchsorted(shingles, np.uint64(1 << 64 - level))] if level else shingles


def _block_pairs(groups: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, node) of members of one group (band, node, label, main) with other labels, one of them outside the
    group's main component, that their samples allow. Each pair comes from the first band that it shares."""
    spark = groups.sparkSession
    n = partitions(spark)
    blocks = groups.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = groups.join(blocks, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.select("band", "node", "label", "main", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))

    def shrink(batch):
        t = Texts.of(batch.column(1))
        got = [_sampled(t.buf[x:y].view(np.uint64)) for x, y in zip(t.offs, t.offs[1:])]
        yield {"node": batch.column(0), "level": [k for k, _ in got], "sample": [u.tobytes() for _, u in got]}

    samples = per_batch(sets.join(rows.select("node").distinct(), "node", "left_semi").select("node", "shingles"), shrink,
                        "node bigint, level int, sample binary")
    held = rows.join(samples, "node").join(classes.select("node", "registers"), "node").select(
        "band", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "node", "label", "main", "level",
        "registers", "sample")

    def compare(batches):
        have, part = None, []
        for b in batches:
            for row in b.to_pylist():
                key = row["band"], row["i"], row["j"]
                if part and key != have:
                    yield from _compared(part, percent)
                    part = []
                have = key
                part.append(row)
        if part:
            yield from _compared(part, percent)

    return (held.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j", "node")
            .mapInArrow(compare, "a bigint, node bigint"))


def _compared(rows: list[dict], percent: int):
    """The passing pairs of one block or pair of blocks."""
    band, two = (rows[0]["band"] >> 48) & 63, rows[0]["i"] != rows[0]["j"]
    node, label, own, level = (np.array([r[c] for r in rows], np.int64) for c in ("node", "label", "own", "level"))
    regs = np.frombuffer(b"".join(r["registers"] for r in rows), np.uint16).reshape(-1, BUCKETS)
    keys = filled(regs)[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
    parts = [np.frombuffer(r["sample"], np.uint64) for r in rows]
    flat = np.concatenate(parts)
    ids = np.unique(flat, return_inverse=True)[1]
    offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    mark = np.zeros(len(flat) + 1, bool)
    a, b = [], []
    for x in np.flatnonzero(label != np.array([r["main"] for r in rows])):
        other = label != label[x]
        if two:
            other &= own != own[x]
        y = np.flatnonzero(other)
        if not len(y):
            continue
        same = (keys[y] == keys[x]).all(2)
        y = y[same.argmax(1) == band]
        for k in np.unique(np.maximum(level[y], level[x])):
            mine = ids[offs[x]:offs[x + 1]]
            low = np.uint64((1 << 64 - int(k)) - 1)
            mine = mine[parts[x] <= low]
            mark[mine] = True
            at = y[np.maximum(level[y], level[x]) == k]
            use = flat <= low
            shared = np.concatenate([[0], np.cumsum(mark[ids] & use)])
            sizes = np.concatenate([[0], np.cumsum(use)])
            mark[mine] = False
            n_shared = shared[offs[at + 1]] - shared[offs[at]]
            union = np.maximum(len(mine) + sizes[offs[at + 1]] - sizes[offs[at]] - n_shared, 1)
            p = percent / 100
            slack = MARGIN * np.sqrt(p * (1 - p) / union) if k else 1e-9
            hit = at[n_shared / union >= p - slack]
            a += [int(node[x])] * len(hit)
            b += node[hit].tolist()
    for i in range(0, len(a), 10000):
        yield pa.RecordBatch.from_arrays([pa.array(a[i:i + 10000], pa.int64()), pa.array(b[i:i + 10000], pa.int64())],
                                         names=["a", "node"])


def links(docs: DataFrame, classes: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """node, root of the classes (node, n, registers) that are linked to others."""
    spark = docs.sparkSession
    bands = _band_rows(classes)
    lone = bands.groupBy("band").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    groups = stage(bands.join(lone, "band", "left_semi"), "bands")

    def full(batch):
        for a, b, t in packed_chunks(batch.column(1)):
            yield {"node": batch.column(0).slice(a, b - a), "shingles": [u.tobytes() for u in shingle_sets(t, size)]}

    mine = groups.select(F.col("node").alias("doc_id")).distinct()
    held = packed_texts(keyed_texts(docs)).join(mine, "doc_id", "left_semi")
    sets = stage(per_batch(held, full, "node bigint, shingles binary"), "sets")
    roots = spark.createDataFrame([], "node bigint, root bigint")
    tested = spark.createDataFrame([], "a bigint, b bigint")
    for turn in range(PIVOT_ROUNDS + 2):
        label = F.coalesce("root", "node").alias("label")
        now = groups.join(roots, "node", "left").select("band", "node", label) if turn else \
            groups.withColumn("label", F.col("node"))
        if turn:  # groups that still hold several components
            sizes = now.groupBy("band", "label").agg(F.count(F.lit(1)).alias("k"))
            main = sizes.groupBy("band").agg(F.max_by("label", F.struct("k", "label")).alias("main"),
                                             F.count(F.lit(1)).alias("parts"), F.sum("k").alias("all"))
            main = main.where("parts > 1 and all > 2")  # two members have met
            now = stage(now.join(main.select("band", "main"), "band"), "open")
            if now.isEmpty():
                break
        if not turn:
            pivot = now.groupBy("band").agg(F.min("node").alias("a"))
            pairs = now.join(pivot, "band").where("node != a")
        elif turn <= PIVOT_ROUNDS:
            least = [F.min(F.struct(F.xxhash64("node", "band", F.lit(turn * PIVOTS + i)).alias("h"), "node")).alias(f"p{i}")
                     for i in range(PIVOTS)]
            pivot = now.where("label = main").groupBy("band").agg(*least)
            pivot = pivot.select("band", F.array(*[F.col(f"p{i}.node") for i in range(PIVOTS)]).alias("a"))
            pairs = now.where("label != main").join(pivot, "band").select("node", F.explode("a").alias("a"))
        else:
            pairs = _block_pairs(now, classes, sets, percent)
        pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        if turn:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = tested.union(pairs) if turn else pairs
        new = stage(_confirmed(_estimated(pairs, classes, percent), sets, percent), "links")
        if not new.isEmpty():
            roots = _joined(roots, new) if turn else components(new)
    return roots


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` (node, root) of the components that the new links (a, b) join; the components before count as nodes."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    over = components(ends).select(F.col("node").alias("root"), F.col("root").alias("top"))
    new = over.select(F.col("root").alias("node"), F.col("top").alias("root")).join(roots, "node", "left_anti")
    return roots.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(new)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs` (doc_id, text)."""
    docs = keyed_texts(docs)
    rows = stage(sketches(docs, size), "sketches")
    full = rows.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    least = full.groupBy("digest").agg(F.min("doc_id").alias("node"))
    # size and registers follow from the set
    classes = stage(full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
                                               F.first("registers").alias("registers"))
                    .select("node", "n", "registers").distinct(), "classes")
    roots = links(docs, classes, size, percent)
    roots = roots.groupBy("node").agg(F.min("root").alias("root"))
    known = least.join(roots, "node", "left").select(F.col("digest").alias("d"), F.coalesce("root", "node").alias("c"))
    both = rows.join(known, rows["digest"] == known["d"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return both.select("doc_id", "n_shingles", own.alias("component_id"),
                       F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all columns as they are, less all but one of each component: the row with the smallest id
    stays, null ids last. Every row is a document of its own here, so rows that share an id or have none are judged by
    their own text, and of repeated rows one stays. Texts without words are linked with nothing and stay."""
    row = free_name(docs, "row_number")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), size, percent)
    ids = rows.select(F.col(row).alias("n"), F.col("doc_id").alias("own"))
    found = stage(found.select(F.col("doc_id").alias("n"), "component_id").join(ids, "n"), "judged")
    least = found.groupBy("component_id").agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "n")).alias("kept"),
                                              F.count(F.lit(1)).alias("k")).where("k > 1")
    gone = found.join(least, "component_id").where(F.col("n") != F.col("kept.n")).select("n")
    return without_numbers(rows, row, gone).select(docs.columns)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op5_near_dedup": op5_near_dedup}
ORACLE = {"op5_near_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.low, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""}
