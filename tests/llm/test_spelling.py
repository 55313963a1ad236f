"""Spelling variants against a brute-force version."""

import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from scorebook.llm import spelling  # noqa: E402
from scorebook.llm.words import Texts  # noqa: E402

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain(rows):
    """{word: (n, n_near, form, form_n, root)}"""
    n = Counter()
    for d, text in rows:
        for m in RUN.findall(text or ""):
            m = m.translate(brute.LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{m}".encode())
            if h % 31 == 0:
                m = m[:h % len(m)] + m[h % len(m) + 1:]
            n[m] += len(m) >= 7
    n = {w: k for w, k in n.items() if k >= 2}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))

    by = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, found in by.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n[w], len(by[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n}


def odd_texts(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéßÿ") for _ in range(rng.randint(6, 11))) for _ in range(12)]
    weight = [1, 12, 150] * 4

    def word():
        w = rng.choices(stems, weight)[0]
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcÀ") + w[i:], w[:i] + rng.choice("xyz") + w[i + 1:], w.upper()])
        return w

    rows = [(i, rng.choice([" ", "\n", "1", "—", "ā"]).join(word() for _ in range(rng.randint(0, 90)))) for i in range(60)]
    long = "q" * 300
    chain = "chainword " * 300 + "chainworx " * 25 + "chaiworx " * 2
    return [*rows, rows[5], (910, chain), (None, rows[6][1]), (900, None), (901, ""), (902, f"{long} {long}x {long} {long}x É"), (903, "ok 1")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = odd_texts(seed)
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id bigint, text string, word string, n int").repartition(3)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df).collect()}
    assert got == plain(rows)
    assert any(v[2] for v in got.values()) and any(v[4] not in (w, v[2]) for w, v in got.items())


@pytest.mark.parametrize("levels", [2, 4, 6])
def test_key_levels_change_nothing(spark, levels):
    want = plain(odd_texts(3))
    words = spark.createDataFrame([(w, v[0]) for w, v in want.items()], "word string, n bigint")
    got = Counter(r.word for r in spelling.near_words(words, spelling.letter_groups(words), levels).collect())
    assert got == Counter({w: v[1] for w, v in want.items() if v[1]})


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_crc_and_letters():
    t = Texts.of(pa.array(["abc déf", "xÿ" * 50, ""]))
    s, e = spelling.letter_runs(t)
    assert [t.buf[a:b].tobytes().decode() for a, b in zip(s, e)] == ["abc", "déf", "xÿ" * 50]
    got = spelling.crc32_spans(t.buf, s, e, np.full(3, zlib.crc32(b"7:"), np.uint32))
    assert got.tolist() == [zlib.crc32(b"7:" + t.buf[a:b].tobytes()) for a, b in zip(s, e)]
    u = spelling.latin(t)
    assert spelling.as_strings(u).to_pylist() == ["abc déf", "xÿ" * 50, ""] and u.offs.tolist() == [0, 7, 107, 107]
