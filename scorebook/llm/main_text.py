"""Main text of web pages by a recurrent block labeller.

A page is cut in leaf blocks (scorebook.llm.html_blocks). Each block is a vector of its
tag path (tag names and words of class, id and role, hashed), its words (hashed) and a few
measures (length, share of linked text, place). A bidirectional LSTM reads the page's
blocks in order and labels each as main text or not; the main blocks, in page order and
joined by a line end, are the text.

The labeller is trained on at most `sample_pages` pages of the table, which label
themselves: blocks inside an article or main element and outside menus, asides, notices
and the like are main text. So that it does not lean on those elements alone, each page is
also dealt into a few made-up layouts: its main and other texts under other tags and
names, main text as lists, code, tables and quotes too (SHAPES), and with the usual
furniture of pages (FURNITURE) around and within. A sample without such elements is
labelled by length and links of the blocks. Pages of any size are sampled; of one of more
than STRETCHES times LONGEST blocks the sample holds stretches of LONGEST blocks from its
start to its end, and of a block the first SAMPLE_CHARS characters, so that the sample is
bounded. Everything but this sample is read whole, with no limit. A table whose pages have
no block at all needs no labeller.

Null and empty pages have an empty text. Broken markup (open quotes, missing end tags, a
page that stops in a tag) is read as browsers do. Rows are handled one by one.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.frames import per_batch, table
from scorebook.llm.html_blocks import Block, blocks
from scorebook.llm.labeller import Labeller
from scorebook.llm.words import Texts, doc_of

PATH_SIZE, WORD_SIZE, MEASURES = 128, 32, 8
SAMPLE_PAGES, LAYOUTS, LONGEST = 150, 8, 120
STRETCHES, SAMPLE_CHARS = 3, 2000
PAGES_AT_ONCE = 256

#: Elements and names that hold the main text, and those that don't.
MAIN = frozenset("article main .articlebody".split())
OTHER = frozenset("nav aside footer form button dialog menu header .ad .ads .advert .advertisement .banner .breadcrumb "
                  ".breadcrumbs .comment .comments .cookie .consent .disqus .footer .header .login .menu .nav .navbar "
                  ".navigation .newsletter .notice .pagination .popup .promo .related .reply .replies .search .share "
                  ".sidebar .social .sponsored .subscribe .tags .toolbar .widget".split())
#: Furniture of pages, by the kind of block that holds it.
FURNITURE = {
    ".cookie": ["We use cookies to improve your experience.", "Accept all cookies", "Cookie settings"],
    ".comments": ["Comments (12)", "Anna says: I do not agree with this at all.", "Reply", "Leave a comment",
                  "Great post, thanks for sharing!", "Posted by guest on 3 May at 10:15"],
    ".newsletter": ["Subscribe to our newsletter", "Your e-mail address", "Sign up"],
    ".sidebar": ["Related articles", "Most read", "Popular posts", "Archive", "Categories", "Recent comments"],
    ".menu": ["Home", "About us", "Contact", "News", "Sport", "Login", "Search", "Skip to content"],
    ".share": ["Share this article", "Tweet", "Facebook", "Print", "E-mail"],
    ".footer": ["© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "Back to top"],
    ".ad": ["Advertisement", "Buy now and save 50%", "Sponsored content", "Order today, free delivery"],
    ".notice": ["This page uses JavaScript.", "You are reading an archived version of this page."],
    ".form": ["Name", "Message", "Send", "Search this site", "Password", "Remember me"],
}
#: Tags and names that made-up layouts give to these kinds, and to the main text.
ASIDE_TAGS = {".menu": ["nav", "ul", "div"], ".footer": ["footer", "div"], ".form": ["form"], ".sidebar": ["aside", "div"]}
MAIN_PATHS = [("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".entry"),
              ("section", ".story"), ("div", ".article", ".body"), ("div",), ("div", "div"), ("section",), ("td",)]
#: Tags of main text beside long paragraphs, and names of reader comments.
SHAPES = [("p",), ("p",), ("ul", "li"), ("ol", "li"), ("pre",), ("table", "tr", "td"), ("table", "tbody", "tr", "td"),
          ("table", "tr", "th"), ("blockquote", "p"), ("blockquote",), ("dl", "dt"), ("dl", "dd"),
          ("figure", "figcaption"), ("h2",), ("h3",), ("div",)]
COMMENT_NAMES = [(".comments",), (".comment",), (".comments", "ol", "li", ".comment"), (".replies",), (".comment", ".list")]
CODE = ["=", "()", "{", "}", ";", "return", "def", "for", "if", "import", "0", "1", "x", "[i]", "//", "->", "print"]


@lru_cache(maxsize=1 << 14)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH_SIZE, np.float32)
    for i, w in enumerate(path[::-1]):
        h = zlib.crc32(w.encode())
        v[h % PATH_SIZE] += (1 if h >> 16 & 1 else -1) * (1.0 if i < 4 else 0.7)
    return v


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """One row per block of each page."""
    sizes = [len(p) for p in pages]
    flat = [b for p in pages for b in p]
    if not flat:
        return [np.zeros((0, PATH_SIZE + WORD_SIZE + MEASURES), np.float32) for _ in pages]
    raw = [b.text.lower().encode("utf-8", "replace") for b in flat]
    t = Texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
    h, w = t.words(21)
    block = doc_of(w)
    sign = np.where(h >> np.uint64(32) & np.uint64(1), 1.0, -1.0)
    bag = np.bincount(block * WORD_SIZE + (h % np.uint64(WORD_SIZE)).astype(np.int64), sign, len(flat) * WORD_SIZE)
    n_words = np.diff(w)
    bag = bag.reshape(-1, WORD_SIZE)
    bag /= np.maximum(np.sqrt((bag * bag).sum(1)), 1)[:, None]  # of length one, however often a word repeats
    chars = np.array([len(b.text) for b in flat], float)
    place = np.concatenate([np.arange(n) / max(n - 1, 1) for n in sizes])
    ends = np.array([b.text[-1] in ".!?…:;»”\"" for b in flat], float)
    measures = np.stack([
        np.log1p(chars) / 6, np.log1p(n_words) / 5, np.array([b.linked for b in flat]) / chars, place, ends,
        np.array(["p" in b.path[-1:] for b in flat], float),
        np.array([any(x in ("h1", "h2", "h3", "h4") for x in b.path[-2:]) for b in flat], float), np.ones(len(flat))], 1)
    rows = np.concatenate([np.stack([_path_vector(b.path) for b in flat]), bag, measures], 1).astype(np.float32)
    return np.split(rows, np.cumsum(sizes)[:-1])


def own_labels(page: list[Block]) -> np.ndarray:
    """Labels from the page's own elements, else from length and links."""
    has = any(MAIN & set(b.path) for b in page)
    out = []
    for b in page:
        at = max([i for i, w in enumerate(b.path) if w in MAIN], default=-1)
        if has:
            out.append(at >= 0 and not OTHER & set(b.path[at:]))
        else:
            out.append(not OTHER & set(b.path) and b.linked < 0.5 * len(b.text) and len(b.text.split()) >= 10)
    return np.array(out, np.float32)


def made_up(page: list[Block], labels: np.ndarray, rng) -> tuple[list[Block], np.ndarray]:
    """The page's texts in another layout, with furniture."""
    pick = lambda xs: xs[rng.integers(len(xs))]
    outer = ("html", "body") + pick([(), ("div",), ("div", ".wrapper"), ("div", ".page"), ("table", "tr")])
    main = outer + pick(MAIN_PATHS)
    named = rng.random() < 0.7
    out: list[tuple[Block, int]] = []

    def furniture(kind, inside=()):
        names, tag = pick(COMMENT_NAMES) if kind == ".comments" else (kind,), pick(ASIDE_TAGS.get(kind, ["div", "section"]))
        plain = not named or tag in ("nav", "footer", "form", "aside") and rng.random() < 0.5  # the element tells
        path = outer + inside + (tag,) + (() if plain else names)
        linked = kind in (".menu", ".share", ".sidebar", ".footer") and rng.random() < 0.8
        for _ in range(rng.integers(1, 7)):
            text = pick(FURNITURE[kind])
            if kind == ".comments" and rng.random() < 0.5 and len(page):
                text = pick(page).text
            out.append((Block(text, path + pick([(), ("p",), ("p",), ("li",), ("h3",)]), len(text) if linked else 0), 0))

    for kind in rng.permutation([".menu", ".cookie", ".ad", ".notice", ".share", ".form"])[:rng.integers(0, 4)]:
        furniture(str(kind))
    body = [b for b, y in zip(page, labels) if y]
    shaped = rng.random() < 0.8
    for b in body:
        last = b.path[-1] if b.path and not b.path[-1].startswith(".") else "p"
        out.append((Block(b.text, main + (last,), b.linked), 1))
        if shaped and rng.random() < 0.3:  # a list, a table, code and the like after it, of this page's words
            shape, words = pick(SHAPES), pick(body).text.split()
            for _ in range(rng.integers(1, 8)):
                n, at = int(rng.integers(1, pick([3, 12]))), int(rng.integers(0, len(words)))
                some = words[at:at + n] if shape != ("pre",) else [w for x in words[at:at + 3 * n] for w in (x, pick(CODE))]
                out.append((Block(" ".join(some), main + shape, 0), 1))
                if shape in (("pre",), ("h2",), ("h3",), ("blockquote",), ("div",)):
                    break
        if rng.random() < 0.04:
            furniture(pick([".ad", ".share", ".newsletter"]), main[len(outer):])
    others = [b for b, y in zip(page, labels) if not y]
    for b in others:
        kind = pick([".ad", ".footer", ".sidebar", ".comments"])
        out.append((Block(b.text, outer + (pick(ASIDE_TAGS.get(kind, ["div"])), kind), b.linked), 0))
    for kind in rng.permutation([".comments", ".sidebar", ".newsletter", ".footer", ".share"])[:rng.integers(1, 5)]:
        furniture(str(kind), main[len(outer):] if kind == ".comments" and rng.random() < 0.7 else ())
    return [b for b, _ in out], np.array([y for _, y in out], np.float32)


def shortened(page: list[Block], rng) -> list[Block]:
    """The page with a fifth of its blocks cut to some words: a label must not hang on a block's length."""
    out = []
    for b in page:
        if rng.random() < 0.2:
            words = b.text.split()
            at = int(rng.integers(0, len(words)))
            text = " ".join(words[at:at + int(rng.integers(1, 6))])
            b = Block(text, b.path, min(b.linked, len(text)))
        out.append(b)
    return out


def labelled(page: str | None) -> list[list[tuple[Block, float]]]:
    """The page's blocks with their own labels, at once or, of a long page, in stretches from its start to its end."""
    have = blocks(page)
    if not have:
        return []
    y = own_labels(have)
    cut = [(Block(b.text[:SAMPLE_CHARS], b.path, min(b.linked, SAMPLE_CHARS)), float(v)) for b, v in zip(have, y)]
    if len(cut) <= STRETCHES * LONGEST:
        return [cut]
    starts = np.linspace(0, len(cut) - LONGEST, STRETCHES).astype(int)
    return [cut[a:a + LONGEST] for a in starts]


def train(pages: list[str | None], layouts: int = LAYOUTS, seed: int = 5) -> Labeller:
    """A labeller from a bounded sample of pages."""
    return train_on([s for page in pages for s in labelled(page)], layouts, seed)


def train_on(sample: list[list[tuple[Block, float]]], layouts: int = LAYOUTS, seed: int = 5) -> Labeller:
    """A labeller from a bounded sample of labelled stretches of pages."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for stretch in sample:
        have, y = [b for b, _ in stretch], np.array([v for _, v in stretch], np.float32)
        for seq, lab in [(have, y)] * 2 + [(shortened(have, rng), y) for _ in range(2)] + [made_up(have, y, rng) for _ in range(layouts)]:
            a = rng.integers(0, max(1, len(seq) - LONGEST + 1))  # long samples give a stretch each time
            xs.append(seq[a:a + LONGEST])
            ys.append(lab[a:a + LONGEST])
    model = Labeller(PATH_SIZE + WORD_SIZE + MEASURES)
    if xs:
        model.fit(vectors(xs), ys, epochs=10)
    return model


def sample_of(pages: DataFrame, sample_pages: int) -> list[list[tuple[Block, float]]]:
    """Labelled stretches of at most `sample_pages` pages, cut where the pages are read."""

    def cut(batches):
        for b in batches:
            for page in b.column(0):
                if got := labelled(page.as_py()):
                    text = json.dumps([[(x.text, x.path, x.linked, y) for x, y in s] for s in got])
                    yield pa.RecordBatch.from_arrays([pa.array([text])], names=["page"])

    rows = pages.select("html").mapInArrow(cut, "page string").limit(sample_pages).collect()
    return [[(Block(t, tuple(path), n), y) for t, path, n, y in s] for r in rows for s in json.loads(r[0])]


def extract(model: Labeller, pages: list[str | None]) -> list[str]:
    cut = [blocks(p) for p in pages]
    return ["\n".join(b.text for b, p in zip(page, probs) if p > 0.5)
            for page, probs in zip(cut, model.predict(vectors(cut)))]


def main_text(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    model = train_on(sample_of(pages, sample_pages))
    shared = pages.sparkSession.sparkContext.broadcast(model.p)  # a few thousand numbers

    def run(batch):
        model = Labeller(PATH_SIZE + WORD_SIZE + MEASURES)
        model.p = shared.value
        html = batch.column(2)
        for a in range(0, batch.num_rows, PAGES_AT_ONCE):
            texts = extract(model, html.slice(a, PAGES_AT_ONCE).to_pylist())
            yield {"page_id": batch.column(0).slice(a, PAGES_AT_ONCE), "url": batch.column(1).slice(a, PAGES_AT_ONCE),
                   "text": pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()),
                   "n_chars": [len(t) for t in texts]}

    return per_batch(pages, run, "page_id bigint, url string, text string, n_chars bigint")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op3_main_text": op3_main_text}
ORACLE: dict[str, str] = {}
