"""Quality rules as a short-circuit cascade.

Each rule rejects documents by a test on the whole text. On a bounded sample of
`sample_docs` documents every rule is timed and its rejections counted; the cascade then
runs the rules by falling rejections per second, and a document that one rule rejects is
not shown to the next. The sample only sets the order: a document is kept if and only if
no rule rejects it, so the verdict does not depend on the sample, the order or timings.

Null and empty texts have no words; the word-count rule rejects them. Repeated rows are
judged one by one. Documents are read whole, in chunks of whole documents.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scorebook.llm.frames import keyed_texts, per_batch, sample_texts, table
from scorebook.llm.words import IS_SPACE, Texts, chunks, doc_of, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LINE_END = np.zeros(256, bool)
LINE_END[0x0A] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LOWERCASE = np.zeros(256, bool)
LOWERCASE[97:123] = True
LETTER = UPPER | LOWERCASE
LETTER[128:] = True
CODE_POINT = (np.arange(256) & 0xC0) != 0x80

SAMPLE_DOCS = 500


class Features:
    """Measures of some texts, each computed when first asked for."""

    def __init__(self, texts: Texts):
        self.t, self._have = texts, {}

    def _once(self, name: str, make: Callable):
        if name not in self._have:
            self._have[name] = make()
        return self._have[name]

    def take(self, rows: np.ndarray) -> Features:
        return self if len(rows) == len(self.t) else Features(self.t.take(rows))

    @property
    def words(self):
        return self._once("words", self.t.words)

    @property
    def n_words(self):
        return self._once("n_words", lambda: np.diff(self.t.spans()[2]))

    @property
    def word_chars(self):
        return self._once("word_chars", lambda: self.t.count(CODE_POINT[self.t.buf] & ~IS_SPACE[self.t.buf]))

    @property
    def n_symbols(self):
        return self._once("n_symbols", lambda: self.t.count(SYMBOLS[self.t.buf]))

    @property
    def lines(self):
        """Offsets per text, line hashes and earlier-duplicate flags of the lines that hold a word."""

        def make():
            t = self.t
            s, e, w = Texts(t.buf, t.offs).spans(LINE_END)
            if not len(s):
                return w, np.zeros(0, bool)
            c = np.concatenate([[0], np.cumsum(~IS_SPACE[t.buf])])
            full = c[e] > c[s]
            h = t.hashes(s, e)
            doc = doc_of(w)
            order = np.lexsort((np.arange(len(h)), h, doc, ~full))
            again = np.zeros(len(h), bool)
            a, b = order[1:], order[:-1]
            again[a] = (h[a] == h[b]) & (doc[a] == doc[b]) & full[a] & full[b]
            keep = np.concatenate([[0], np.cumsum(full)])
            return keep[w], again[full]

        return self._once("lines", make)

    @property
    def n_lines(self):
        return np.diff(self.lines[0])

    @property
    def n_dup_lines(self):
        offs, again = self.lines
        c = np.concatenate([[0], np.cumsum(again)])
        return c[offs[1:]] - c[offs[:-1]]

    @property
    def n_repeat_words(self):
        """Words inside a 3-word window that the same text holds twice or more."""

        def make():
            h, w = self.words
            pos, g = windows(h, w, 3)
            if not len(pos):
                return np.zeros(len(self.t), np.int64)
            doc = doc_of(w)[pos]
            order = np.lexsort((g, doc))
            g, d = g[order], doc[order]
            same = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
            rep = np.zeros(len(g), bool)
            rep[1:] |= same
            rep[:-1] |= same
            hit = np.zeros(len(h), bool)
            at = pos[order[rep]]
            for j in range(3):
                hit[at + j] = True
            c = np.concatenate([[0], np.cumsum(hit)])
            return c[w[1:]] - c[w[:-1]]

        return self._once("n_repeat_words", make)

    def words_with(self, marks: np.ndarray) -> np.ndarray:
        """Per word, how many of its bytes are marked."""
        s, e, _ = self.t.spans()
        c = np.concatenate([[0], np.cumsum(marks[self.t.buf])])
        return c[e] - c[s]

    def count_words(self, flags: np.ndarray) -> np.ndarray:
        w = self.t.spans()[2]
        c = np.concatenate([[0], np.cumsum(flags)])
        return c[w[1:]] - c[w[:-1]]

    @property
    def shouted(self):
        return self._once("shouted", lambda: self.count_words(
            (self.words_with(UPPER) >= 2) & (self.words_with(LOWERCASE) == 0)))

    @property
    def with_letter(self):
        return self._once("with_letter", lambda: self.count_words(self.words_with(LETTER) > 0))


@dataclass(frozen=True)
class Rule:
    """`rejects` maps Features of some texts to one boolean per text."""

    name: str
    rejects: Callable[[Features], np.ndarray]


def base_rules(min_words: int = 50, max_repeat_percent: int = 50) -> list[Rule]:
    return [Rule("too_few_words", lambda f: f.n_words < min_words),
            Rule("repeated_words", lambda f: 100 * f.n_repeat_words > max_repeat_percent * f.n_words)]


def web_text_rules(max_symbol_percent: int = 10, max_dup_line_percent: int = 30, min_dup_lines: int = 3,
                   max_shout_percent: int = 50, min_letter_percent: int = 70, word_length: tuple[int, int] = (2, 20)) -> list[Rule]:
    """Rules after published web-text filters: symbol and duplicate-line shares, capitals, letters, word length."""
    lo, hi = word_length
    return [
        Rule("symbols", lambda f: 100 * f.n_symbols > max_symbol_percent * f.n_words),
        Rule("duplicate_lines", lambda f: (f.n_dup_lines >= min_dup_lines)
             & (100 * f.n_dup_lines > max_dup_line_percent * f.n_lines)),
        Rule("shouting", lambda f: 100 * f.shouted > max_shout_percent * f.n_words),
        Rule("few_letters", lambda f: 100 * f.with_letter < min_letter_percent * f.n_words),
        Rule("word_length", lambda f: (f.word_chars < lo * f.n_words) | (f.word_chars > hi * f.n_words)),
    ]


def ordered(docs: DataFrame, rules: Sequence[Rule], sample_docs: int = SAMPLE_DOCS) -> list[Rule]:
    """The rules by falling rejections per second on a sample of at most `sample_docs` texts; rules that reject
    nothing come last, the cheapest first."""
    sample = Texts.of(sample_texts(keyed_texts(docs), sample_docs).column(0))

    def key(i):
        began = time.perf_counter()
        rejected = int(np.count_nonzero(rules[i].rejects(Features(sample))))
        took = time.perf_counter() - began
        return -rejected / max(took, 1e-9), took, i

    return [rules[i] for i in sorted(range(len(rules)), key=key)]


def cascade(f: Features, rules: Sequence[Rule], alive: np.ndarray | None = None) -> np.ndarray:
    """True where no rule rejects; each rule sees only the texts that are still alive."""
    alive = np.ones(len(f.t), bool) if alive is None else alive.copy()
    for r in rules:
        rows = np.flatnonzero(alive)
        if not len(rows):
            break
        f2 = f if len(rows) > 0.8 * len(alive) else f.take(rows)
        bad = r.rejects(f2)
        if f2 is f:
            alive &= ~bad
        else:
            alive[rows[bad]] = False
            if len(rows) < 0.5 * len(alive):  # go on with the smaller set
                left = np.flatnonzero(alive[rows])
                alive[rows] = cascade(f2, rules[rules.index(r) + 1:], alive[rows]) if len(left) else False
                break
    return alive


def quality_report(docs: DataFrame, base: Sequence[Rule] | None = None, rules: Sequence[Rule] | None = None,
                   sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row."""
    base = base_rules() if base is None else list(base)
    rules = ordered(docs, web_text_rules() if rules is None else list(rules), sample_docs)

    def run(batch):
        for a, b, t in chunks(batch):
            f = Features(t)
            failed = np.zeros(b - a, bool)
            for r in base:
                failed |= r.rejects(f)
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_words": f.n_words, "word_chars": f.word_chars,
                   "n_symbols": f.n_symbols, "n_dup_lines": f.n_dup_lines, "n_repeat_words": f.n_repeat_words,
                   "base_failed": failed, "kept": cascade(f, rules, ~failed)}

    return per_batch(keyed_texts(docs), run,
                     "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                     "n_repeat_words bigint, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text",
              sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text no rule rejects."""
    rules = ordered(docs, [*base_rules(), *web_text_rules()] if rules is None else list(rules), sample_docs)
    at = docs.schema.names.index(text_col)

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            keep = [cascade(Features(t), rules) for _, _, t in chunks(texts)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLE = {"op1_quality_rules": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
f AS (
  SELECT doc_id, w, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         len(list_filter(w, lambda x: length(regexp_replace(x, '[^A-Z]', '', 'g')) >= 2 AND NOT regexp_matches(x, '[a-z]'))) AS loud,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS letters
  FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(n_words - 1, 1))) AS i FROM f)),
r AS (SELECT doc_id, count(DISTINCT k)::BIGINT AS n
      FROM (SELECT doc_id, unnest(range(i, i + 3)) AS k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1)
      GROUP BY doc_id),
b AS (SELECT f.*, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed
      FROM f LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_symbols <= 10 * n_words AND (n_dup_lines < 3 OR 100 * n_dup_lines <= 30 * n_lines)
       AND 100 * loud <= 50 * n_words AND 100 * letters >= 70 * n_words
       AND word_chars BETWEEN 2 * n_words AND 20 * n_words AS kept
FROM b
"""}
