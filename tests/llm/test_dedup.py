import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from scorebook.llm import collection, meeting, near_duplicates, substrings, suffixes  # noqa: E402
from scorebook.llm.graph import components  # noqa: E402
from scorebook.llm.words import Texts  # noqa: E402

SCHEMA = "doc_id bigint, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def odd_rows(seed, n=40, vocabulary=60, length=80):
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = text(30)
    out = []
    for i in range(n):
        t = text(rng.randint(0, length))
        kind = rng.random()
        if kind < 0.2 and out:
            t = rng.choice(out)[1] or ""
        elif kind < 0.4 and out:
            w = (rng.choice(out)[1] or "").split(" ")
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind < 0.6:
            t = t + "\n" + passage + "\t" + text(5)
        out.append((rng.randrange(10**6), t))
    return [*out, (10**7, None), (10**7 + 1, ""), (10**7 + 2, " \n\t "), (10**7 + 3, text(6000)), (10**7 + 4, "one")]


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(spark, seed):
    rows = odd_rows(seed)
    rows.append((rows[3][0], rows[3][1]))  # a repeated row
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in
                 substrings.dedup_report(frame(spark, rows)).collect())
    want = sorted((d, n, k, hashlib.sha256(x.encode()).hexdigest())
                  for (d, _), (n, k, x) in zip(rows, brute.substrings(rows)))
    assert got == want


def test_substrings_null_ids_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, 1, "a"), (5, text, 2, None), (2, text, 3, "c"), (9, None, 4, "d")]
    df = frame(spark, rows, "doc_id bigint, text string, keys int, __gone string")
    out = {r["keys"]: r for r in substrings.without_repeats(df).collect()}
    assert [out[i].text for i in (1, 2, 3, 4)] == [text, "", text, None]
    assert list(out[1].asDict()) == df.columns and out[2]["__gone"] is None
    assert substrings.dedup_report(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = list({d: (d, t) for d, t in odd_rows(seed, 60, 40, 60)}.values())
    want = brute.components(rows)
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(frame(spark, rows)).collect()}
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.kept == (r.component_id == d) and r.n_shingles == len(brute.shingles(dict(rows)[d]))
               for d, r in got.items())


def test_near_duplicates_chain_and_odd_ids(spark):
    # a chain: neighbours are similar, ends are not; all are one component
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((100 - i, " ".join(base)))
        base[i * 16:i * 16 + 2] = [f"x{i}", f"y{i}"]
    rows += [(None, "a b c d e f"), (None, "a b c d e f"), (1, None), (2, "")]
    assert brute.components(rows[:12])[100] == 89
    got = [(r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got[i] for i in range(len(got)) if got[i][0] is not None) == sorted(
        [(100 - i, 89, i == 11) for i in range(12)] + [(1, 1, True), (2, 2, True)])
    assert [g for g in got if g[0] is None] == [(None, None, True)] * 2
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(a[:2600]), np.unique(a[400:])]
    regs = near_duplicates.sketch(sets)
    same = ((regs[0] == regs[1]) & (regs[0] > 0)).mean()
    true = 2200 / 3000
    assert abs(same - true) < 5 * np.sqrt(true * (1 - true) / near_duplicates.BUCKETS)
    assert near_duplicates.sketch([np.zeros(0, np.uint64)]).sum() == 0


def test_components_of_a_long_path(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


@pytest.mark.parametrize("group", [1, 64])
def test_suffixes_equal_brute_force(spark, group):
    rows = odd_rows(7, 30) + [(77, "é" * 900), (78, "abc" * 400)]
    rows.append(rows[0])
    out = suffixes.suffix_report(frame(spark, rows), length=48, gram=16, group=group)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    want = sorted((d, n, k, s, hashlib.sha256(x).hexdigest()) for (d, _), (n, k, s, x) in zip(rows, brute.repeats(rows, 48)))
    assert got == want


def test_suffixes_null_ids_and_long_segments(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    rng = random.Random(3)
    a = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(None, a), (None, a[500:1200]), (3, a[:100] + "x" + a[2000:2600]), (4, None), (5, "")]
    from scorebook.llm.words import Texts

    buf = np.frombuffer(a.encode(), np.uint8)
    starts = [s for _, s, size, _, _ in suffixes.stretches(Texts(buf, np.array([0, len(buf)])), 48, 16)]
    assert len(starts) > 1  # several segments
    out = suffixes.suffix_report(frame(spark, rows), length=48, gram=16)
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    assert got == sorted((n, k, s, hashlib.sha256(x).hexdigest()) for n, k, s, x in brute.repeats(rows, 48))
    assert suffixes.suffix_report(frame(spark, [])).count() == 0


def test_suffixes_at_the_full_length(spark):
    """57 shared words of 399 bytes stay; 400 bytes go from every copy, the first one and those within a document too."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    own = lambda: " ".join(word() for _ in range(100))
    short, long, twice = (" ".join(word() for _ in range(57)) + end for end in (".", "..", ".."))
    assert [len(x) for x in (short, long, twice)] == [399, 400, 400]
    rows = [(d, f"{own()}{d}{x}{d}{own()}") for d, x in ((1, short), (2, short), (3, long), (4, long), (5, own()))]
    rows.append((6, f"{own()}6{twice}7{twice}8{own()}"))
    out = suffixes.suffix_report(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in out} == {
        1: (0, 0), 2: (0, 0), 3: (400, 1), 4: (400, 1), 5: (0, 0), 6: (800, 2)}
    want = sorted((d, n, k, s, hashlib.sha256(x).hexdigest()) for (d, _), (n, k, s, x) in zip(rows, brute.repeats(rows, 400)))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == want


def test_suffixes_of_many_equal_rows(spark):
    """The spans of a row do not grow with the number of rows like it, so the work grows with that number only."""
    rng = random.Random(4)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(2))
    sizes = []
    for n in (20, 80):
        rows = [(None, a)] * n + [(3, a)] * n + [(4, b[:600] + a[100:300] + b[600:])]
        both = suffixes.with_spans(frame(spark, rows), length=48, gram=16).collect()
        sizes.append(max(len(r.spans) for r in both if r.spans))
        out = suffixes.suffix_report(frame(spark, rows), length=48, gram=16).collect()
        assert sorted((r.doc_id or 0, r.n_removed) for r in out) == [(0, 2000)] * n + [(3, 2000)] * n + [(4, 200)]
    assert sizes[0] == sizes[1]


def test_collection_order_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        ss = [bytes(rng.choice(b"ab\xc3\xa9") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 6))]
        lens = np.array([len(s) for s in ss])
        columns = np.zeros((lens.max() + 1, len(ss)), np.int64)
        for i, s in enumerate(ss):
            columns[:len(s), i] = np.frombuffer(s, np.uint8)[::-1].astype(int) + 1
        symbols, common = collection.build(columns, lens, 5)
        order = sorted((s[i:], s[i - 1:i] if i else b"") for s in ss for i in range(len(s) + 1))
        prefix = [0]
        for (a, _), (b, _) in zip(order, order[1:]):
            k = 0
            while k < min(len(a), len(b), 5) and a[k] == b[k]:
                k += 1
            prefix.append(k)
        assert list(common) == prefix
        assert sorted(symbols) == sorted(p[0] + 1 if p else 0 for _, p in order)
        for length, block in ((3, 1), (4, 2), (6, 3)):
            for i, got in enumerate(collection.shared_starts(ss, length, block)):
                others = ss[:i] + ss[i + 1:]
                assert list(got) == [k for k in range(len(ss[i]) - length + 1)
                                     if any(ss[i][k:k + length] in o for o in others)]


@pytest.mark.parametrize("block", [3, 1024])
def test_near_duplicates_by_blocks(spark, monkeypatch, block):
    """Without pivots the block comparison must find all links that the first round leaves, large sets included."""
    monkeypatch.setattr(near_duplicates, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = random.Random(9)
    base, rows = [f"w{i}" for i in range(220)], []
    for i in range(14):
        copy = list(base)
        for _ in range(rng.randint(2, 9)):
            copy[rng.randrange(220)] = f"e{i}"
        rows.append((1000 - i, " ".join(copy)))
    long = [f"v{i}" for i in range(3000)]
    rows += [(10 + i, " ".join(long[:2600 + 60 * i])) for i in range(6)]
    want = brute.components(rows)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(frame(spark, rows)).collect()}
    assert got == want and len(set(want.values())) < len(rows)


@pytest.mark.parametrize("empty", [None, "", "too short"])
def test_substrings_after_many_rows_without_windows(spark, empty):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(70000, passage), (70001, f"more {passage}")]
    none = spark.range(70000).select("id", F.lit(empty).cast("string")).toDF("doc_id", "text")
    docs = none.union(spark.createDataFrame(rows, SCHEMA)).coalesce(1)
    assert substrings.dedup_report(docs).where("n_removed > 0").select("doc_id", "n_removed").collect() == [(70001, 20)]


@pytest.mark.parametrize("exact", [False, True])
def test_a_batch_of_many_documents(exact):
    batch, ids = meeting.Batch(1, exact, False), np.arange(10**6, 10**6 + 69_999)
    key = np.arange(len(ids), dtype=np.uint64) // np.uint64(2)  # two neighbours share one
    assert not batch.add(ids[:59_999], np.arange(59_999), key[:59_999], None)
    assert batch.add(ids[59_999:], np.arange(10_000), key[59_999:], None)
    rows = [r for b in batch.rows() for r in b.to_pylist()]
    answers = [(r["batch"], r["kind"], r["payload"]) for r in rows if r["bucket"] < 0]
    for bucket in {r["bucket"] for r in rows} - {-1}:
        head = np.array([bucket], np.int64).tobytes()
        sent = [(r["batch"], r["kind"], r["payload"]) for r in rows if r["bucket"] == bucket]
        answers += [(b, meeting.PROBE, head + p) for b, p in meeting._merge(sent, exact, False)]
    assert [d for d, _ in meeting._by_document(answers, exact, False)] == ids[:-1].tolist()


def test_block_pairs_of_every_band(spark):
    """Two members that share only one band, whichever it is, are compared there."""
    nd = near_duplicates
    words = lambda tag: nd.shingle_sets(Texts.of(pa.array([" ".join(f"{tag}{i}" for i in range(120))])))[0]
    regs = nd.sketch([words("a"), words("b"), words("c")])
    shingles = words("a").tobytes()
    for band in (0, 19, 20, nd.BANDS - 1):
        mine = nd.filled(regs).copy()
        mine[1:, band * nd.ROWS:(band + 1) * nd.ROWS] = mine[0, band * nd.ROWS:(band + 1) * nd.ROWS]
        rows = [{"band": band << 48, "i": 0, "j": 0, "own": 0, "node": k, "label": k, "main": 0, "level": 0,
                 "registers": r.tobytes(), "sample": shingles} for k, r in enumerate(mine)]
        got = [x for b in nd._compared(rows, 75) for x in zip(*b.to_pydict().values())]
        assert {tuple(sorted(x)) for x in got} == {(0, 1), (0, 2), (1, 2)}
    kinds = "band long, node long, label long, main long"
    groups = spark.createDataFrame([(41 << 48, k, k, 0) for k in range(3)], kinds)
    classes = spark.createDataFrame([(k, r.tobytes()) for k, r in enumerate(mine)], "node long, registers binary")
    sets = spark.createDataFrame([(k, shingles) for k in range(3)], "node long, shingles binary")
    got = nd._block_pairs(groups, classes, sets, 75).collect()
    assert {tuple(sorted(x)) for x in got} == {(0, 1), (0, 2), (1, 2)}


def test_keep_one_of_each_with_shared_and_null_ids(spark):
    text = lambda tag: " ".join(f"{tag}{i}" for i in range(60))
    rows = [(3, text("a"), 1), (7, text("a") + " end", 2), (7, text("b"), 3), (7, text("c"), 4), (7, text("c"), 4),
            (9, text("b") + " end", 5), (None, text("d"), 6), (None, text("d"), 6), (None, text("c"), 7),
            (None, text("e"), 8), (None, text("f"), 9), (5, None, 10), (6, "", 11)]
    df = frame(spark, rows, "doc_id bigint, text string, row_number int")
    out = near_duplicates.keep_one_of_each(df)
    assert out.columns == df.columns
    assert sorted((tuple(r) for r in out.collect() if r.doc_id is not None), key=lambda r: (r[0], r[2])) == sorted(
        [rows[i] for i in (0, 2, 3, 11, 12)], key=lambda r: (r[0], r[2]))
    assert sorted(r.row_number for r in out.collect() if r.doc_id is None) == [6, 8, 9]
    assert near_duplicates.keep_one_of_each(frame(spark, [], df.schema)).count() == 0


def test_filled_reads_only_what_is_still_empty():
    """One set with a single filled register among full ones takes many rounds; the others aren't read again in them."""
    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            out = super().__getitem__(at)
            Counted.read += np.size(out)
            return out

    nd, rng = near_duplicates, np.random.default_rng(1)
    regs = rng.integers(1, 1 << 16, (400, nd.BUCKETS)).astype(np.uint16)
    regs[7], regs[9, ::2] = 0, 0
    regs[7, 3] = 5
    want, order = regs.copy(), np.random.default_rng(nd.BUCKETS)
    while (want == 0).any():
        want = np.where(want == 0, regs[:, order.integers(0, nd.BUCKETS, nd.BUCKETS)], want)
    got = nd.filled(regs.view(Counted))
    assert (np.asarray(got) == want).all() and (want[7] == 5).all()
    assert Counted.read < 2 * regs.size
    regs[0] = 0  # an empty set among them: nothing is filled
    assert (nd.filled(regs) == regs).all()


def test_keep_one_of_each_shuffles_no_rows(spark, monkeypatch):
    """Without broadcasts the texts go into no shuffle of the last step, and packed into that of the sets."""
    monkeypatch.setattr(near_duplicates, "packed_texts", lambda df, f=near_duplicates.packed_texts: packed.append(df) or f(df))
    packed = []
    text = lambda tag: " ".join(f"{tag}{i}" for i in range(60))
    rows = [(i, text(f"t{i % 30}x") + (" end" if i % 2 else ""), i, None) for i in range(90)] + [(500, None, 1, "a"), (501, "", 2, "b")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_duplicates.keep_one_of_each(frame(spark, rows, "doc_id bigint, text string, n_chars int, lang string"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        assert len(packed) == 1
        assert sorted(tuple(r) for r in out.collect()) == sorted(rows[:30] + rows[-2:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
