"""The stream with keyed state: corrections replace rows once; late files, replays and a crash add nothing."""

import os

import pandas as pd
import pytest

from fixtures import DOCS
from scorebook.plans import drops as D
from scorebook.plans.refresh import Layout
from scorebook.sources.commit_log import CommitLog
from scorebook.streaming import corrections as C
from test_drops import CORRECTED, state


@pytest.fixture(autouse=True)
def session(spark):
    conf = {**C.STATE_STORE, "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def layout(tmp_path):
    (tmp_path / "landing").mkdir()
    return Layout(landing=str(tmp_path / "landing"), tables=str(tmp_path / "tables"))


def land(layout, folder, docs):
    os.makedirs(os.path.join(layout.landing, folder), exist_ok=True)
    for key, text in docs.items():
        with open(os.path.join(layout.landing, folder, f"{key}.yaml"), "w") as f:
            f.write(text)


def test_decide():
    assert C.decide(None, "a", "x") == C.decide(None, None, "x") == "new"
    assert C.decide(("b", "y"), "c", "y") == C.decide((None, "y"), None, "y") == "same"
    assert C.decide(("b", "y"), "a", "x") == C.decide(("b", "y"), "b", "x") == "late"
    assert C.decide(("b", "y"), None, "z") == C.decide((None, "y"), None, "z") == "unreadable"
    assert C.decide(("b", "y"), "c", "z") == C.decide((None, "z"), "a", "x") == "replace"


def test_files_of_a_match_in_many_parts():
    class Held:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    p = C.NewestDocument()
    p._held = Held()
    rows = pd.DataFrame([("m", "b", "b", "y"), ("m", "d", None, "w"), ("m", "c", "c", "z"), ("m", "a", "a", "x")],
                        columns=["match_id", "path", "drop", "digest"])
    for size in (1, 2, 4):
        p._held.value = ("b", "y")
        out = pd.concat(list(p.handleInputRows(("m",), iter([rows[i:i + size] for i in range(0, 4, size)]), None)))
        assert dict(zip(out["path"], out["decision"])) == {"a": "late", "b": "late", "c": "replace", "d": "late"}
        assert p._held.value == ("c", "z")


def test_corrections_late_files_and_replays(spark, layout, tmp_path, monkeypatch):
    ckpt = str(tmp_path / "ckpt")
    go = lambda log=None: C.start_corrections_stream(spark, layout, ckpt, log=log).awaitTermination()
    land(layout, "d2", {"1001": DOCS["1001"], "1002": DOCS["1002"], "1003": DOCS["1003"]})
    go()
    first = state(spark, layout)
    assert [len(first[k]) for k in ("deliveries", "match_info", "registry", "loaded")] == [4, 2, 4, 3]

    land(layout, "d1", {"1001": CORRECTED})  # late
    land(layout, "d3", {"1002": DOCS["1002"]})  # the same again
    go()
    assert state(spark, layout) == first

    land(layout, "d4", {"1001": CORRECTED, "1003": DOCS["1003"] + " again"})  # a correction, a broken file for a broken one

    class Dies(CommitLog):
        def put(self, number, **entry):
            raise RuntimeError("no")

    with pytest.raises(Exception):  # the run is written, its commit isn't
        go(Dies(f"{layout.tables}/drops/log"))
    assert state(spark, layout) == first
    batches = []
    commit = C.commit_batch
    monkeypatch.setattr(C, "commit_batch", lambda lay, log, b, i: batches.append((i, commit(lay, log, b, i), commit(lay, log, b, i))))
    go()  # the batch is replayed; handed over twice it counts once
    now = state(spark, layout)
    assert [(c["replace"], c["unreadable"], again) for _, c, again in batches if c] == [(1, 1, {})]
    assert [len(now[k]) for k in ("deliveries", "match_info", "registry", "loaded")] == [3, 2, 4, 3]
    assert any("York" in r for r in now["match_info"]) and not any("Leeds" in r for r in now["match_info"])
    broken = D.committed(spark, layout, D.drops_log(layout), "quarantine").where("fatal").collect()
    assert sorted(r.match_id for r in broken) == ["1003", "1003"]
    go()
    assert state(spark, layout) == now
