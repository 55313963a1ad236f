"""Near duplicates among embeddings: links at a cosine of LEAST or more, by small-world graphs per shard.

Equal vectors are one class (an exchange with a map-side part; copies don't travel). Classes are dealt by the hash of
their vector over shards of at most SHARD_BYTES, at least MIN_SHARDS of them; a task builds a shard's graph, writes it
to the shared folder and audits it. Then every class is asked of every shard: tasks over blocks of classes map the
shards' files one after the other, so no vector is shuffled for it.

A node of a graph stands for all vectors of its ball, those within half of the linking angle: any two of a ball are
linked. By its angle to the node and the ball's radius a query is linked with all of a ball, with none, or is compared
with each member, in double precision. So a large group of near copies costs a few comparisons a query, and its pairs
are counted but never listed: what comes out are a count per class and a spanning forest of each block's links.

A search returns the `beam` nearest nodes. The audit asks AUDIT vectors of the whole table (those of smallest hash) and
as many made at the linking angle from the shard's own nodes, compares with all vectors of the shard, and doubles the
beam until RECALL of their links are found; at the size of the graph the search is an exact scan. A query whose beam
ends inside the reach of a ball doubles its own beam, up to all nodes, so no link is lost to a full beam.

Vectors that are null, empty, zero or hold null or non-finite entries link with nothing; so do rows without id, whose
component is null. Vectors of different lengths are not linked. Rows that repeat an id or a vector count each. Extra
columns are left out, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.frames import partitions, stage, table
from scorebook.llm.graph import components
from scorebook.llm.shared_files import map_arrays, write_arrays
from scorebook.llm.small_world import SmallWorld
from scorebook.llm.whitening import vector_rows
from scorebook.llm.words import ragged
from scorebook.session import checkpoint_dir

LEAST, RECALL = 0.9, 0.99
MIN_SHARDS, SHARD_BYTES = 4, 1 << 26
AUDIT, FIRST_BEAM, QUERY_BLOCK, MEMBER_PAIRS = 64, 32, 8192, 1 << 16
KEY = np.dtype([("x", "<u8"), ("y", "<u8")])  # a digest, as two numbers that sort
SLACK = 1e-7  # radians: far above the rounding of an angle, far below any that matters


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1, in doubles (scaled first, so that no square over- or underflows)."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(np.einsum("ij,ij->i", a, b), -1, 1))


def keyed_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, digest (null for vectors that link with nothing), d, v (doubles as bytes) of every row."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            digest, data, size = [None] * len(ids), [None] * len(ids), [0] * len(ids)
            for rows, m in vector_rows(batch.column(1)):
                m = m + 0.0  # one zero
                for i in np.flatnonzero(m.any(1)).tolist():
                    if ids[int(rows[i])].is_valid:
                        raw = m[i].tobytes()
                        digest[rows[i]], data[rows[i]], size[rows[i]] = xxhash.xxh3_128_digest(raw), raw, m.shape[1]
            yield pa.RecordBatch.from_arrays([ids, pa.array(digest, pa.binary()), pa.array(size, pa.int32()), pa.array(data, pa.binary())],
                                             names=["vec_id", "digest", "d", "v"])

    rows = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(run, "vec_id bigint, digest binary, d int, v binary")


class Shard:
    """The vectors of one length in one shard, their balls and the graph over the balls' nodes."""

    def __init__(self, arrays: dict[str, np.ndarray], d: int):
        self.a, self.d = arrays, d
        self.raw = arrays["vectors"].reshape(-1, d)  # by ball: members of node k are rows start[k] to start[k + 1]
        self.start, self.node, self.weight, self.radius = (arrays[k] for k in ("start", "node", "weight", "radius"))
        self.lead = unit(self.raw[self.start[:-1]])  # a ball's first member is its node
        levels = int(arrays["levels"][0])
        near = [arrays[f"near{i}"].reshape(len(self.start) - 1 if not i else len(arrays[f"members{i}"]), -1) for i in range(levels)]
        self.graph = SmallWorld(self.lead.astype(np.float32), near, [arrays[f"members{i}"] for i in range(levels)], int(arrays["levels"][1]))
        self.beam = int(arrays["levels"][2])

    def balls_near(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, ball) pairs that may hold links, from searches whose beams reach beyond the largest ball."""
        far = float(np.cos(min(math.pi, math.acos(least) + float(self.radius.max()) + SLACK))) - 1e-5
        todo, a, b = np.arange(len(q)), [], []
        asked = q.astype(np.float32)
        while len(todo):
            ids, sims = self.graph.search(asked[todo], beam)
            full = (sims[:, -1] >= far) & (beam < len(self.lead))
            r, c = np.nonzero((sims >= far) & ~full[:, None] & (ids >= 0))
            a.append(todo[r])
            b.append(ids[r, c].astype(np.int64))
            todo, beam = todo[full], min(2 * beam, len(self.lead))
        return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2

    def links(self, q: np.ndarray, own: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per query its linked rows (less its own class, the member `own` or -1), and (query, ball) pairs with a link.

        A query's own ball is always compared."""
        a, b = self.balls_near(q, least, beam)
        mine = np.flatnonzero(own >= 0)
        home = np.searchsorted(self.start, own[mine], side="right") - 1
        pairs = np.unique(np.concatenate([a * len(self.lead) + b, mine * len(self.lead) + home]))
        a, b = pairs // len(self.lead), pairs % len(self.lead)
        reach, angle = math.acos(least), angles(q[a], self.lead[b])
        count = np.zeros(len(q), np.int64)
        total = np.concatenate([[0], np.cumsum(self.weight)])
        whole = angle + self.radius[b] <= reach - SLACK
        linked = whole.copy()
        np.add.at(count, a[whole], total[self.start[b[whole] + 1]] - total[self.start[b[whole]]])
        some = np.flatnonzero(~whole & (angle - self.radius[b] <= reach + SLACK))
        size = self.start[b[some] + 1] - self.start[b[some]]
        for part in _parts(size, MEMBER_PAIRS):
            pair = np.repeat(some[part], size[part])
            member = ragged(self.start[b[some[part]]], size[part])
            for x in range(0, len(pair), MEMBER_PAIRS):
                p, m = pair[x:x + MEMBER_PAIRS], member[x:x + MEMBER_PAIRS]
                hit = (np.einsum("ij,ij->i", q[a[p]], unit(self.raw[m])) >= least) | (m == own[a[p]])
                np.add.at(count, a[p[hit]], self.weight[m[hit]])
                linked[p[hit]] = True
        count[mine] -= self.weight[own[mine]]
        return count, a[linked], b[linked]


def _parts(size: np.ndarray, most: int):
    """Index ranges whose sizes add up to about `most` (a larger one stands alone)."""
    at, ends = 0, np.cumsum(size)
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield np.arange(at, to)
        at = to


def build_shard(raw: np.ndarray, nodes: np.ndarray, weight: np.ndarray, digest: np.ndarray, audit: np.ndarray,
                least: float) -> tuple[dict[str, np.ndarray], float]:
    """The arrays of a shard (digests as 16 bytes each) and the recall of its last audit."""
    order = np.lexsort((digest["y"], digest["x"]))  # the hash's order: the same graph whenever a task runs again
    raw, nodes, weight, digest = raw[order], nodes[order], weight[order], digest[order]
    u = unit(raw)
    chance = (digest["y"].astype(np.float64) + 1) / 2.0**64
    apart = math.cos(math.acos(least) / 2) + 1e-6
    graph, stands = SmallWorld.build(u.astype(np.float32), chance, apart)
    first = np.full(len(graph.x), len(raw))
    np.minimum.at(first, stands, np.arange(len(raw)))
    order = np.lexsort((np.arange(len(raw)) != first[stands], stands))
    start = np.concatenate([[0], np.cumsum(np.bincount(stands, minlength=len(graph.x)))])
    raw, u = raw[order], u[order]
    to_lead = angles(u, u[np.repeat(start[:-1], np.diff(start))])
    to_lead[start[:-1]] = 0
    arrays = {"vectors": raw.ravel(), "start": start, "node": nodes[order], "weight": weight[order],
              "digest": np.frombuffer(digest[order].tobytes(), np.uint8), "radius": np.maximum.reduceat(to_lead, start[:-1]),
              **{f"near{i}": n.ravel() for i, n in enumerate(graph.near)}, **{f"members{i}": m for i, m in enumerate(graph.members)},
              "levels": np.array([len(graph.near), graph.entry, FIRST_BEAM], np.int64)}
    shard = Shard(arrays, raw.shape[1])
    rng = np.random.default_rng(len(raw))
    base = u[rng.integers(0, len(u), AUDIT)]
    side = rng.normal(size=base.shape)
    side = side - np.einsum("ij,ij->i", side, base)[:, None] * base
    edge = least + 1e-9
    made = edge * base + math.sqrt(1 - edge * edge) * side / np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    asked = np.concatenate([unit(audit), unit(made)]) if len(audit) else unit(made)
    true = np.zeros(len(asked), np.int64)
    for x in range(0, len(u), QUERY_BLOCK):
        true += ((asked @ u[x:x + QUERY_BLOCK].T) >= least) @ shard.weight[x:x + QUERY_BLOCK]
    none = np.full(len(asked), -1)
    while True:
        got = shard.links(asked, none, least, shard.beam)[0]
        recall = float(np.minimum(got, true).sum() / max(true.sum(), 1))
        if recall >= RECALL or shard.beam >= len(shard.lead):
            break
        shard.beam *= 2
    arrays["levels"][2] = shard.beam
    arrays["by_digest"] = np.argsort(arrays["digest"].view(KEY)["x"], kind="stable")
    return arrays, recall if true.any() else 1.0


def _name(d: int, shard: int) -> str:
    return f"{d}-{shard:06d}"


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges as stars: each node but a star's smallest with that smallest."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        if (root[x] == low).all() and (root[y] == low).all():
            break
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
    more = np.flatnonzero(root != np.arange(len(names)))
    return names[more], names[root[more]]


def shards_of(classes: DataFrame, folder: str, least: float) -> DataFrame:
    """Builds and audits all shards: d, shard, vectors, nodes, beam, recall of each (on its first row) and its links inside
    balls (a, b)."""
    spark = classes.sparkSession
    sizes = {r["d"]: max(MIN_SHARDS, -(-r["n"] * r["d"] * 8 // SHARD_BYTES)) for r in
             classes.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length
    audit: dict[int, list] = {}
    for d in sizes:
        audit[d] = [r["v"] for r in classes.where(F.col("d") == d).orderBy("digest").limit(AUDIT).select("v").collect()]

    def run(batches):
        have, part = None, []

        def done():
            (d, shard), t = have, pa.Table.from_batches(part)
            raw = np.frombuffer(b"".join(t["v"].to_pylist()), np.float64).reshape(-1, d)
            digest = np.frombuffer(b"".join(t["digest"].to_pylist()), KEY)
            arrays, recall = build_shard(raw, t["node"].to_numpy(), t["size"].to_numpy(), digest,
                                         np.frombuffer(b"".join(audit[d]), np.float64).reshape(-1, d), least)
            write_arrays(folder, _name(d, shard), arrays)
            start, node = arrays["start"], arrays["node"]
            a, b = _forest(node, node[np.repeat(start[:-1], np.diff(start))])
            n = max(len(a), 1)
            head = np.arange(n) == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, d), pa.int32()), pa.array(np.full(n, shard), pa.int32()),
                 pa.array(np.full(n, len(node)), mask=~head), pa.array(np.full(n, len(start) - 1), mask=~head),
                 pa.array(np.full(n, int(arrays["levels"][2])), mask=~head), pa.array(np.full(n, recall), mask=~head),
                 pa.array(a if len(a) else [None], pa.int64()), pa.array(b if len(b) else [None], pa.int64())],
                names=["d", "shard", "vectors", "nodes", "beam", "recall", "a", "b"])

        for batch in batches:
            d, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = (np.flatnonzero((np.diff(d) != 0) | (np.diff(s) != 0)) + 1).tolist()
            for x, y in zip([0, *cut], [*cut, len(d)]):
                if have != (int(d[x]), int(s[x])):
                    if part:
                        yield from done()
                    have, part = (int(d[x]), int(s[x])), []
                part.append(batch.slice(x, y - x))
        if part:
            yield from done()

    count = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])[F.col("d")] if sizes else F.lit(1)
    number = F.pmod(F.xxhash64("digest"), count).cast("int")
    rows = classes.select("d", number.alias("shard"), "digest", "node", "size", "v")
    dealt = rows.repartition(max([partitions(spark), *sizes.values()]), "d", "shard").sortWithinPartitions("d", "shard")
    return dealt.mapInArrow(run, "d int, shard int, vectors bigint, nodes bigint, beam bigint, recall double, a bigint, b bigint")


def _members(theirs: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted digest is in `theirs` (-1: not there); `order` sorts theirs."""
    at, have = np.searchsorted(theirs["x"][order], wanted["x"]), theirs[order]
    out, live = np.full(len(wanted), -1), np.arange(len(wanted))
    while len(live):  # one step but for digests whose halves agree
        live = live[at[live] < len(have)]
        live = live[have["x"][at[live]] == wanted["x"][live]]
        same = have["y"][at[live]] == wanted["y"][live]
        out[live[same]] = order[at[live[same]]]
        live = live[~same]
        at[live] += 1
    return out


def asked_everywhere(classes: DataFrame, folder: str, shards: dict[int, list[int]], least: float) -> DataFrame:
    """Every class asked of every shard of its length: (digest, links) rows, and (a, b) rows that connect nodes."""

    def answered(d, nodes, digest, raw):
        q, total, x, y = unit(raw), np.zeros(len(raw), np.int64), [], []
        for s in shards[d]:
            arrays = map_arrays(folder, _name(d, s))
            shard = Shard(arrays, d)
            own = _members(arrays["digest"].view(KEY), arrays["by_digest"], digest)
            count, a, b = shard.links(q, own, least, shard.beam)
            total += count
            u, v = _forest(nodes[a], shard.node[shard.start[b]])
            x.append(u)
            y.append(v)
        x, y = _forest(np.concatenate(x), np.concatenate(y)) if x else (np.zeros(0, np.int64),) * 2
        blank = pa.nulls
        digests = pa.array([digest[i].tobytes() for i in range(len(digest))], pa.binary())
        yield pa.RecordBatch.from_arrays([digests, pa.array(total), blank(len(total), pa.int64()), blank(len(total), pa.int64())],
                                         names=["digest", "links", "a", "b"])
        if len(x):
            yield pa.RecordBatch.from_arrays([blank(len(x), pa.binary()), blank(len(x), pa.int64()), pa.array(x), pa.array(y)],
                                             names=["digest", "links", "a", "b"])

    def run(batches):
        held, rows = {}, {}
        for batch in batches:
            d = batch.column(0).to_numpy()
            for dim in np.unique(d).tolist():
                some = batch.take(pa.array(np.flatnonzero(d == dim)))
                held.setdefault(dim, []).append(some)
                rows[dim] = rows.get(dim, 0) + len(some)
                if rows[dim] >= QUERY_BLOCK:
                    yield from block(dim, held.pop(dim))
                    rows[dim] = 0
        for dim, parts in held.items():
            yield from block(dim, parts)

    def block(dim, parts):
        t = pa.Table.from_batches(parts)
        yield from answered(dim, t["node"].to_numpy(), np.frombuffer(b"".join(t["digest"].to_pylist()), KEY),
                            np.frombuffer(b"".join(t["v"].to_pylist()), np.float64).reshape(-1, dim))

    return classes.select("d", "node", "digest", "v").mapInArrow(run, "digest binary, links bigint, a bigint, b bigint")


def linked_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = embeddings.sparkSession
    rows = stage(keyed_vectors(embeddings, id_col, vector_col), "vectors")
    whole = rows.where(F.col("digest").isNotNull())
    classes = stage(whole.groupBy("digest", "d", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size"))
                    .repartition(partitions(spark)), "classes")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-graphs-{uuid.uuid4().hex}"
    built = stage(shards_of(classes, folder, least), "shards")
    shards: dict[int, list[int]] = {}
    for r in built.where(F.col("vectors").isNotNull()).select("d", "shard").collect():  # the files that must be there
        shards.setdefault(r["d"], []).append(r["shard"])
    found = stage(asked_everywhere(classes, folder, shards, least), "answers") if shards else None
    pairs = built.select("a", "b").where(F.col("a").isNotNull())
    # rows of one vector are one component, whatever their ids
    copies = whole.join(classes.where("size > 1").select("digest", "node"), "digest").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    pairs = pairs.union(copies)
    links = classes.select("digest", "size", F.lit(0).cast("bigint").alias("links"))
    if found is not None:
        pairs = pairs.union(found.select("a", "b").where(F.col("a").isNotNull()))
        links = classes.select("digest", "size").join(found.select("digest", "links").where(F.col("digest").isNotNull()), "digest")
    roots = components(pairs).groupBy("node").agg(F.min("root").alias("root"))
    own = F.coalesce("root", "vec_id")
    return (rows.select("vec_id", "digest").join(links, "digest", "left").join(roots, F.col("vec_id") == F.col("node"), "left")
            .select("vec_id", F.coalesce(F.col("links") + F.col("size") - 1, F.lit(0)).cast("bigint").alias("n_links"),
                    own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept")))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_embedding_dedup": op13_embedding_dedup}
ORACLE: dict[str, str] = {}
