"""The log of drops: corrections, late drops, two runs at once, a crash between the steps."""

import os
import threading

import pytest

from fixtures import DOCS, EVENTS, write_helpers
from scorebook.operators.keys import version_decisions
from scorebook.plans import drops as D
from scorebook.plans.refresh import Layout, build_dataset_from_tables
from scorebook.sources.commit_log import CommitLog


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture()
def layout(tmp_path):
    helpers = write_helpers(str(tmp_path / "helpers"))
    (tmp_path / "landing").mkdir()
    return Layout(landing=str(tmp_path / "landing"), tables=str(tmp_path / "tables"), people=helpers["people"],
                  cricinfo=helpers["cricinfo"], leagues=helpers["leagues"])


def drop(layout, name, docs, events=None, done=True):
    folder = os.path.join(layout.landing, name, "part")  # files may lie deeper
    os.makedirs(folder)
    for files, suffix in ((docs, "yaml"), (events or {}, "json")):
        for key, text in files.items():
            with open(os.path.join(folder, f"{key}.{suffix}"), "w") as f:
                f.write(text)
    if done:
        mark(layout, name)


def mark(layout, name):
    with open(os.path.join(layout.landing, f"{name}.done"), "w") as f:
        f.write("done\n")


def report(**counts):
    return {**dict.fromkeys(["drops", *D.DECISIONS, "retried"], 0), **counts}


def state(spark, layout):
    """Rows of the three tables and the loaded keys, as text."""
    log = D.drops_log(layout)
    tables = D.current_tables(spark, layout, log) | {"loaded": D.committed(spark, layout, log, "loaded").drop("run")}
    return {k: sorted(map(str, df.collect())) for k, df in tables.items()}


CORRECTED = DOCS["1001"].replace("city: Leeds", "city: York").replace(
    "    - 0.2: {batsman: A Ann, bowler: D Dan, non_striker: B Bob, runs: {batsman: 0, extras: 0, total: 0}, "
    "wicket: {kind: bowled, player_out: A Ann}}\n", "")


def test_put_once_per_number(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    assert log.head(spark) is None and log.entries(spark).count() == 0
    won, start = [], threading.Barrier(16)

    def writer(i):
        start.wait()
        if log.put(1, run=f"r{i}", drops=[], keys=0):
            won.append(f"r{i}")

    threads = [threading.Thread(target=writer, args=(i,)) for i in range(16)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and log.head(spark)["run"] == won[0]
    assert os.listdir(tmp_path / "log") == [f"{1:020d}.json"]  # nothing left of the losers
    assert log.put(2, run="next") and log.head(spark)["number"] == 2 and log.entries(spark, 1).count() == 1
    with pytest.raises(ValueError):
        CommitLog("s3://bucket/log")


def test_version_decisions(spark):
    held = spark.createDataFrame([("a", "d2", "x"), ("b", "d2", "x"), ("c", "d2", "x"), ("e", None, None), ("f", None, "x"),
                                  ("g", "d2", "x")], "match_id string, drop string, digest string")
    batch = spark.createDataFrame([("a", "d3", "x"), ("b", "d3", "y"), ("c", "d1", "y"), ("d", "d1", "x"), ("e", "d1", None),
                                   ("f", "d1", "y"), ("g", None, "y"), (None, "d1", "x")], held.schema)
    got = {r.match_id: r.decision for r in version_decisions(held, batch).collect()}
    assert got == {"a": "same", "b": "replace", "c": "late", "d": "new", "e": "same", "f": "replace", "g": "late", None: "new"}
    assert version_decisions(held, batch.limit(0)).count() == 0
    assert {r.decision for r in version_decisions(held.limit(0), batch).collect()} == {"new"}


def test_drops_load_once_and_unfinished_ones_wait(spark, layout):
    assert D.refresh_drops(spark, layout) == report()
    drop(layout, "d1", {"1001": DOCS["1001"]}, {"1001": EVENTS["1001"]})
    drop(layout, "d2", {"1002": DOCS["1002"]}, done=False)
    assert D.refresh_drops(spark, layout) == report(drops=1, new=1)
    mark(layout, "d2")
    mark(layout, "d3")  # a drop without files
    assert D.refresh_drops(spark, layout, most=1) == report(drops=2, new=1)  # two runs
    now = state(spark, layout)
    assert D.refresh_drops(spark, layout) == report() and state(spark, layout) == now
    assert [len(now[k]) for k in ("deliveries", "match_info", "registry", "loaded")] == [4, 2, 4, 2]
    head = D.drops_log(layout).head(spark)
    assert (head["number"], head["mark"], head["drops"]) == (3, "d3", ["d3"])


def test_files_of_earlier_drops_are_not_listed(spark, layout, monkeypatch):
    drop(layout, "d1", {"1001": DOCS["1001"]})
    D.refresh_drops(spark, layout)
    roots = []
    monkeypatch.setattr(D, "list_documents", lambda s, root, suffix: roots.append(root) or D_list(s, root, suffix))
    drop(layout, "d2", {"1002": DOCS["1002"]})
    D.refresh_drops(spark, layout)
    assert roots and all(r.endswith("/{d2}") for r in roots)


D_list = D.list_documents


def test_corrected_repeated_and_late_documents(spark, layout):
    """A corrected document replaces its rows once; equal content, older drops and broken files change nothing."""
    drop(layout, "d1", {"1001": DOCS["1001"], "1002": DOCS["1002"], "1003": DOCS["1003"]}, {"1001": EVENTS["1001"]})
    assert D.refresh_drops(spark, layout) == report(drops=1, new=3)
    drop(layout, "d3", {"1001": CORRECTED, "1002": DOCS["1002"]})
    assert D.refresh_drops(spark, layout) == report(drops=1, replace=1, same=1)
    now = state(spark, layout)
    assert len(now["deliveries"]) == 3 and len(now["match_info"]) == 2 and len(now["registry"]) == 4
    assert any("York" in r and "World Cup" in r for r in now["match_info"]) and not any("Leeds" in r for r in now["match_info"])
    drop(layout, "d2", {"1001": DOCS["1001"]})  # late
    assert D.refresh_drops(spark, layout) == report(drops=1, late=1)
    drop(layout, "d4", {"1001": "info: {teams: [A"})  # a broken correction
    assert D.refresh_drops(spark, layout) == report(drops=1, unreadable=1)
    assert state(spark, layout) == now
    problems = D.committed(spark, layout, D.drops_log(layout), "quarantine")
    assert {r.match_id for r in problems.where("fatal").collect()} == {"1001", "1003"}
    drop(layout, "d0", {"1003": DOCS["1002"]})  # the broken file repaired, whatever its drop
    assert D.refresh_drops(spark, layout) == report(drops=1, replace=1)
    assert len(state(spark, layout)["match_info"]) == 3
    assert {r.match_id for r in D.committed(spark, layout, D.drops_log(layout), "quarantine").where("fatal").collect()} == {"1001"}


def test_two_runs_at_once(spark, layout):
    """Another writer commits the same drops, and one more, just before this one does: its rows count once."""
    drop(layout, "d1", {"1001": DOCS["1001"]})

    class Slow(CommitLog):
        def put(self, number, **entry):
            if number == 1:
                drop(layout, "d2", {"1001": CORRECTED, "1002": DOCS["1002"]})
                assert D.refresh_drops(spark, layout, most=1) == report(drops=2, new=2, replace=1)
            return super().put(number, **entry)

    assert D.refresh_drops(spark, layout, Slow(layout.table("drops/log"))) == report(retried=1)
    now = state(spark, layout)
    assert [len(now[k]) for k in ("deliveries", "match_info", "registry", "loaded")] == [3, 2, 4, 2]


@pytest.mark.parametrize("step", ["loaded", "commit"])
def test_crash_between_the_steps(spark, layout, monkeypatch, step):
    drop(layout, "d1", {"1001": DOCS["1001"]}, {"1001": EVENTS["1001"]})
    D.refresh_drops(spark, layout)
    before = state(spark, layout)
    drop(layout, "d2", {"1001": CORRECTED, "1002": DOCS["1002"]}, {"1002": EVENTS["1002"]})
    path = D._path

    def broken(*a, **k):
        if step == "commit" or a[1:] == (step,) and len(seen) > 1:
            raise RuntimeError("no")
        seen.append(a[1:])
        return path(*a)

    seen = []
    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(CommitLog, "put", broken)
        else:  # the first two lookups read the tables
            m.setattr(D, "_path", broken)
        with pytest.raises(RuntimeError):
            D.refresh_drops(spark, layout, D.CommitLog(f"{layout.tables}/drops/log"))
    assert state(spark, layout) == before
    assert D.refresh_drops(spark, layout) == report(drops=1, new=1, replace=1)
    assert [len(v) for v in state(spark, layout).values()] == [3, 2, 4, 2]


def test_dataset_follows_the_log(spark, layout):
    """Corrections and late events rebuild their own matches only; the rows equal a full build's, and of two publishers one
    wins and the other starts again."""
    for i, date in (("2001", "2019-03-01"), ("2002", "2019-01-01")):
        drop(layout, f"d{i}", {i: DOCS["1001"].replace("2020-07-01", date)})
    with pytest.raises(ValueError):
        D.read_drops_dataset(spark, layout)
    D.refresh_drops(spark, layout)
    D.publish_drops(spark, layout)
    files = {os.path.join(d, f) for d, _, names in os.walk(layout.table("wide_dataset")) for f in names if f.endswith(".parquet")}
    drop(layout, "d3", {"2002": CORRECTED.replace("2020-07-01", "2019-01-01")}, {"2002": EVENTS["1001"]})
    D.refresh_drops(spark, layout)

    class Slow(CommitLog):
        def put(self, number, **entry):
            if number == 2:
                D.publish_drops(spark, layout)
            return super().put(number, **entry)

    D.publish_drops(spark, layout, built=Slow(layout.table("drops/dataset_log")))
    assert D.dataset_log(layout).head(spark)["number"] == 2
    after = {os.path.join(d, f) for d, _, names in os.walk(layout.table("wide_dataset")) for f in names if f.endswith(".parquet")}
    assert files <= after
    assert {r.match_id for r in spark.read.parquet(*(after - files)).select("match_id").distinct().collect()} == {"2002"}
    got = D.read_drops_dataset(spark, layout)
    rows = got.collect()
    assert sorted(r.delivery_id for r in rows) == list(range(1, 8))
    assert {(r.match_id, r.event, r.city) for r in rows} == {("2001", None, "Leeds"), ("2002", "World Cup", "York")}
    tables = D.current_tables(spark, layout, D.drops_log(layout))
    whole = build_dataset_from_tables(spark, layout, **tables).select(got.columns)
    assert sorted(map(str, rows)) == sorted(map(str, whole.collect()))
    assert D.publish_drops(spark, layout) == 0 and D.dataset_log(layout).head(spark)["number"] == 2
