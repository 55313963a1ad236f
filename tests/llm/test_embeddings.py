"""Near duplicates among embeddings against brute force."""

from pathlib import Path

import numpy as np
import pytest

from pyspark.sql import functions as F

from scorebook.llm import embedding_links, language_model, shared_files
from scorebook.llm.small_world import SmallWorld

SCHEMA = "vec_id bigint, embedding array<float>, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, least=0.9):
    """{position: (n_links, component)}; rows that link with nothing have their own id."""
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    u = {k: np.array(rows[k][1], np.float32).astype(float) for k in ok}
    n, root = {k: 0 for k in range(len(rows))}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, a in enumerate(ok):
        for b in ok[x + 1:]:
            if len(u[a]) == len(u[b]) and u[a] @ u[b] / np.linalg.norm(u[a]) / np.linalg.norm(u[b]) >= least:
                n[a], n[b] = n[a] + 1, n[b] + 1
                low, high = sorted((find(rows[a][0]), find(rows[b][0])))
                root[high] = low
    return sorted((str(i), n[k], str(find(i))) for k, (i, _) in enumerate(rows))


def near(rng, v, cos):
    side = rng.normal(size=len(v))
    side -= side @ v / (v @ v) * v
    return cos * v / np.linalg.norm(v) + np.sqrt(1 - cos * cos) * side / np.linalg.norm(side)


def odd_rows(seed, d=16):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=d) for _ in range(120)]
    hub, chain = rng.normal(size=d), rng.normal(size=d)
    out += [near(rng, hub, c) for c in rng.uniform(0.9, 1, 80)]  # a crowd that partly links
    out += [near(rng, out[5], c) for c in (0.895, 0.899, 0.901, 0.92, 0.99)]
    for _ in range(10):
        out.append(chain)
        chain = near(rng, chain, 0.93)
    out += [out[7] * 3, out[8] * 1e-20, -out[9]] + [out[10]] * 40
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(10**6)[:len(out)], out)]
    rows += [rows[3], (rows[4][0], rows[6][1]), (None, rows[5][1]), (2000001, None), (2000002, [0.0] * d), (2000003, []),
             (2000004, [1.0, None] + [0.0] * (d - 2)), (2000005, [float("nan")] * d), (2000006, [1.0]), (2000007, [2.0]), (2000008, [-2.0])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = odd_rows(seed)
    got = embedding_links.linked_embeddings(frame(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == plain(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_a_third_in_one_crowd(spark):
    rng = np.random.default_rng(3)
    hub = rng.normal(size=32)
    vectors = [near(rng, hub, c) for c in rng.uniform(0.985, 1, 700)] + [rng.normal(size=32) for _ in range(1400)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in embedding_links.linked_embeddings(frame(spark, rows)).collect())
    assert got == plain(rows)


def test_audits_widen_the_beam():
    rng = np.random.default_rng(4)
    raw = rng.normal(size=(3000, 24))
    digest = rng.integers(0, 2**63, (3000, 2)).astype(np.uint64).view(embedding_links.KEY).ravel()
    first = embedding_links.FIRST_BEAM
    try:
        embedding_links.FIRST_BEAM = 1
        arrays, recall = embedding_links.build_shard(raw, np.arange(3000), np.ones(3000, np.int64), digest, raw[:64], 0.9)
    finally:
        embedding_links.FIRST_BEAM = first
    assert recall >= embedding_links.RECALL and arrays["levels"][2] > 1


def test_graph_recall():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph, stands = SmallWorld.build(x, rng.random(4000))
    assert (stands == np.arange(4000)).all() and len(graph.near) > 1
    ids, sims = graph.search(x[:400], 64)
    true = np.argsort(-(x[:400] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids.tolist(), true.tolist())]) > 0.9
    ids, _ = graph.search(x[:5], 4000)
    assert (ids[:, :10] == true[:5]).all()


def test_empty_table(spark):
    assert embedding_links.linked_embeddings(frame(spark, [])).count() == 0
    assert [tuple(r) for r in embedding_links.linked_embeddings(frame(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_files_of_a_remote_store(tmp_path, monkeypatch):
    monkeypatch.setattr(shared_files, "_local", lambda uri: None)  # as any store that is not mounted
    folder = f"file://{tmp_path}/graphs"
    shared_files.write_arrays(folder, "a", {"x": np.arange(5), "y": np.ones(3)})
    assert [p.name for p in (tmp_path / "graphs").iterdir()] == ["a"]
    assert shared_files.map_arrays(folder, "a")["x"].tolist() == list(range(5))
    with pytest.raises(FileNotFoundError):
        shared_files.map_arrays(folder, "b")
    monkeypatch.undo()
    assert shared_files.map_arrays(folder, "a")["y"].tolist() == [1, 1, 1]
    with pytest.raises(FileNotFoundError):
        shared_files.map_arrays(folder, "b")


def test_a_lost_model_file_raises(spark, tmp_path):
    words = "one two three four five six".split()
    rows = [(i, " ".join(words[(i * j) % 6] for j in range(20))) for i in range(40)]
    model = language_model.train(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kind, bucket = "bigrams", min(model["files"]["bigrams"])
    path = Path(shared_files._local(model["folder"])) / kind / f"{bucket:06d}"
    look = language_model.Lookup(model)
    assert look._file(kind, bucket) is not None
    path.rename(tmp_path / "lost")
    with pytest.raises(FileNotFoundError):
        language_model.Lookup(model)._file(kind, bucket)
