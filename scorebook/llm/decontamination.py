"""Benchmark decontamination by winnowing, in DataFrame and SQL functions only.

Of the k-gram hashes of every `window` words the smallest is a fingerprint (k = GRAM,
window - k + 1 hashes), on both sides; so each span of `window` words that a document
shares with a benchmark item has a fingerprint in common with it, wherever it lies. The
fingerprints are joined, and each hit is extended: the windows that hold the hit are
compared with the benchmark's windows word by word. Items of fewer words than a window
are one window of their own length, for which winnowing guarantees nothing; for each such
length (at most window - 1 of them, found in the benchmark) all grams of the documents
are fingerprints.

Long texts are cut in overlapping pieces of PIECE words, so an array stays small. The
benchmark's fingerprints are broadcast if they number at most `broadcast_rows`, which is
counted first; beyond that both sides are shuffled by fingerprint.

Null and empty texts have no words: a document of them has no hits, an item no windows.
Rows are told apart by doc_id and text, so repeated rows get equal results and rows that
share an id (null included) keep their own. Repeated items count once; null item_ids are
left out of the digest and the count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorebook.llm.frames import free_name, stage, table

WINDOW, GRAM, PIECE = 10, 5, 4096
BROADCAST_ROWS = 1 << 20

#: The characters that end a word, and the letters that are lower-cased.
ENDS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), UPPER + ENDS, UPPER.lower() + " " * len(ENDS))
    return F.array_remove(F.split(flat, " "), "")


def _once(value: Column, use) -> Column:
    """`use` of a value that is computed once, whatever the optimiser inlines."""
    return F.element_at(F.transform(F.array(value), use), 1)


def pieces(rows: DataFrame, window: int, piece: int) -> DataFrame:
    """id, key, off, w: overlapping pieces of a text's words (`off` words before a piece)."""

    def cut(ws):
        last = F.greatest(F.size(ws) - window, F.lit(0)) / F.lit(piece)
        return F.transform(F.sequence(F.lit(0), F.floor(last).cast("int")),
                           lambda c: F.slice(ws, c * F.lit(piece) + F.lit(1), F.lit(piece + window - 1)))

    return (rows.select("id", "key", F.posexplode(_once(words(F.col("text")), cut)).alias("at", "w"))
            .select("id", "key", (F.col("at") * piece).alias("off"), "w").where(F.size("w") > 0))


def _grams(w: Column, size: int, bits: int) -> Column:
    """Hash of each run of `size` words, its low bits replaced by the run's 1-based position."""
    low = (1 << bits) - 1
    run = F.sequence(F.lit(1), F.size(w) - F.lit(size - 1))
    return F.when(F.size(w) >= size, F.transform(run, lambda i: F.xxhash64(F.slice(w, i, F.lit(size)))
                                                 .bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")))
                  ).otherwise(F.array().cast("array<bigint>"))


def _winnowed(w: Column, window: int, gram: int, bits: int) -> Column:
    """The distinct smallest grams of all windows."""
    per = window - gram + 1
    smallest = lambda p: F.transform(F.sequence(F.lit(1), F.size(p) - F.lit(per - 1)),
                                     lambda i: F.array_min(F.slice(p, i, F.lit(per))))
    return F.when(F.size(w) >= window, F.array_distinct(_once(_grams(w, gram, bits), smallest))
                  ).otherwise(F.array().cast("array<bigint>"))


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """item, win (words joined by a space) of every `size` words of the rows (item, ws)."""
    run = F.sequence(F.lit(1), F.size("ws") - F.lit(size - 1))
    return rows.where(F.size("ws") >= size).select(
        "item", F.explode(F.transform(run, lambda i: F.array_join(F.slice("ws", i, F.lit(size)), " "))).alias("win"))


def _hits(part: DataFrame, prints: Column, tests: DataFrame, window: int, gram: int, bits: int,
          broadcast_rows: int) -> DataFrame:
    """id, key, start, size, win: places in the documents of the tests' windows (start counts words from 0).

    `tests` has one row per distinct window (win) with its fingerprint (print)."""
    low = (1 << bits) - 1
    known = tests.select("print").distinct()
    small = known.count() <= broadcast_rows
    before = window - gram
    around = F.slice("w", F.greatest(F.col("pos") - F.lit(before), F.lit(1)), F.lit(2 * window - gram))
    cols = ["id", "key", "off", "pos", around.alias("near")]
    found = (part.select("id", "key", "off", "w", F.explode(prints).alias("f"))
             .select("id", "key", "off", "w", F.col("f").bitwiseAND(F.lit(~low)).alias("print"),
                     F.col("f").bitwiseAND(F.lit(low)).cast("int").alias("pos")))
    if small:
        found = found.join(F.broadcast(known), "print").select(*cols)
    else:
        found = found.select(*cols, "print").join(known, "print").select("id", "key", "off", "pos", "near")
    first = F.greatest(F.col("pos") - F.lit(before), F.lit(1))
    runs = F.sequence(F.lit(0), F.size("near") - F.lit(window))
    starts = (found.where(F.size("near") >= window)
              .select("id", "key", F.col("off") + first - 1 + F.lit(0), "near", F.posexplode(runs).alias("j", "x"))
              .toDF("id", "key", "base", "near", "j", "x")
              .select("id", "key", (F.col("base") + F.col("j")).cast("bigint").alias("start"),
                      F.array_join(F.slice("near", F.col("j") + 1, F.lit(window)), " ").alias("win")))
    wins = tests.select("win")
    same = starts.join(F.broadcast(wins) if small and wins.count() <= broadcast_rows else wins, "win")
    return same.distinct().withColumn("size", F.lit(window))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, piece: int = PIECE,
                  broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Two frames for `docs` (doc_id, text) and `benchmark` (item_id, text): places (id, key, start, size, win),
    distinct, and windows (win, item), distinct. `key` is xxhash64 of the text."""
    bits = (piece + window).bit_length()
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), "text")
    items = benchmark.select(F.col("item_id").alias("item"), words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    short = sorted(r[0] for r in items.where(F.size("ws") < window).select(F.size("ws")).distinct().collect())
    tests = _windows(items, window)
    all_windows, places = tests, None
    part = pieces(rows, window, piece)
    plans = [(window, gram, tests, _winnowed(F.col("w"), window, gram, bits))]
    for m in short:  # fewer than `window` lengths
        own = _windows(items.where(F.size("ws") == m), m)
        all_windows = all_windows.union(own)
        plans.append((m, m, own, _grams(F.col("w"), m, bits)))
    low = (1 << bits) - 1
    for size, k, own, prints in plans:
        ws = F.split("win", " ")
        least = _once(_grams(ws, k, bits), lambda p: F.array_min(p))
        known = own.select("win").distinct().withColumn("print", least.bitwiseAND(F.lit(~low)))
        got = _hits(part, prints, known, size, k, bits, broadcast_rows)
        places = got if places is None else places.union(got)
    # written once: two reports read these few rows, and the pass over all texts must not run twice
    return stage(places.select("id", "key", "start", "size", "win"), "places"), all_windows.distinct()


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of `docs`."""
    places, wins = contamination(docs, benchmark, **options)
    before = Window.partitionBy("id", "key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.select("id", "key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.col("start"))),
                       F.lit(0))
    hit = spans.select("id", "key", fresh.alias("n")).groupBy("id", "key").agg(F.sum("n").alias("n_hit"))
    items = (places.select("id", "key", "win").distinct().join(wins, "win").where(F.col("item").isNotNull())
             .groupBy("id", "key").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items")))
    found = hit.join(items, (hit["id"].eqNullSafe(items["id"])) & (hit["key"] == items["key"]), "left").select(
        hit["id"], hit["key"], "n_hit", "items")
    rows = docs.select("doc_id", F.xxhash64("text").alias("own"),
                       F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("bigint").alias("n_words"))
    both = rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["own"] == found["key"]), "left")
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return both.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns as they are, that hold no benchmark window."""
    places, _ = contamination(docs, benchmark, **options)
    own, key = free_name(docs, "hit_id"), free_name(docs, "hit_key")
    bad = places.select(F.col("id").alias(own), F.col("key").alias(key)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad[own]) & (F.xxhash64(docs["text"]) == bad[key]), "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontamination": op4_decontamination}

ORACLE = {"op4_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
t AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM t),
g AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) AS i FROM d, sizes)),
p AS (SELECT DISTINCT g.doc_id, g.i, g.size, g.win FROM g JOIN (SELECT DISTINCT win, size FROM t) s USING (win, size)),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM p) GROUP BY doc_id),
n AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM p JOIN t USING (win, size) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(n.items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(n.items, ','), '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""}
