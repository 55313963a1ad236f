"""Token counts by a two-tier lookup of pre-tokens (no pre-token is shuffled).

A text is cut before each run of spaces: no piece of the vocabulary holds a space mark
after another character, so merges never cross such a cut and the counts of the parts
add up to the library's count of the whole text (checked when the counter is built).
Tier one is a compact hash table (hash -> token count) of the most frequent pre-tokens
of a bounded sample (at most `sample_docs` texts), broadcast to all tasks; its size is the parameter `slots`.
Tier two is a bounded cache in each Python worker; what neither holds is encoded by the
library once per chunk of text.

Null and empty texts have no bytes and no tokens. Ids may repeat or be null: rows are
handled one by one. Text of any length is read in chunks of whole documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from scorebook.llm.frames import keyed_texts, per_batch, sample_texts, table
from scorebook.llm.words import Texts, chunks

SPACE, MARK = b" ", "▁"
SLOTS = 1 << 16
SAMPLE_DOCS = 1000
CACHE = 1 << 18

#: Per Python worker: model -> (processor, {pre-token hash: token count}); lives across tasks.
_WORKER: dict[int, tuple] = {}


def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """The cut is exact only under these properties of the model; anything else is refused."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model)
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces:
        raise ValueError("the model's normaliser changes text; pre-token counts would not add up")
    if any(MARK in p.piece.lstrip(MARK) for p in m.pieces):
        raise ValueError("a piece holds a space mark after another character")
    if any(p.type == 4 for p in m.pieces):
        raise ValueError("user-defined symbols are matched before merging")


def prepared(col: pa.Array) -> pa.Array:
    """Each text as the model sees it: literal space marks as spaces, one space in front of a text."""
    col = pc.fill_null(col, "")
    col = pc.replace_substring(col, MARK, " ")
    return pc.if_else(pc.equal(pc.binary_length(col), 0), "", pc.binary_join_element_wise(" ", col, ""))


def pretokens(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and offsets per text: a cut before each run of spaces."""
    n = len(t.buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(t) + 1, np.int64)
    space = t.buf == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    edge = t.offs[:-1]
    first[edge[edge < n]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], n), np.searchsorted(starts, t.offs)


def plain(t: Texts, s: int, e: int) -> str:
    """A pre-token without the space that the library puts in front itself."""
    return t.buf[s + 1:e].tobytes().decode("utf-8", "replace")


def lengths(sp, words: list[str]) -> list[int]:
    """Token counts of pre-tokens; a lone space (at the end of a text) can't be encoded by itself."""
    lone = len(sp.encode("a ")) - len(sp.encode("a"))
    return [len(ids) if w else lone for w, ids in zip(words, sp.encode(words, num_threads=1))]


def add_up(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[offs[1:]] - c[offs[:-1]]


def frequent_table(sample: pa.RecordBatch, model: bytes, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Open hash table with one probe: slot = low bits of the hash; the more frequent pre-token keeps its slot."""
    t = Texts.of(prepared(sample.column(0)))
    s, e, _ = pretokens(t)
    h, at, n = np.unique(t.hashes(s, e).view(np.int64), return_index=True, return_counts=True)
    rare_first = np.argsort(n, kind="stable")
    slot = h & (slots - 1)
    owner = np.full(slots, -1)
    owner[slot[rare_first]] = rare_first  # the last, most frequent, stays
    used = np.flatnonzero(owner >= 0)
    keys, counts = np.zeros(slots, np.int64), np.full(slots, -1, np.int32)
    keys[used] = h[owner[used]]
    counts[used] = lengths(load(model), [plain(t, s[i], e[i]) for i in at[owner[used]]]) if len(used) else []
    return keys, counts


def count_tokens(docs: DataFrame, model: bytes, slots: int = SLOTS, sample_docs: int = SAMPLE_DOCS,
                 cache: int = CACHE) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of `docs` (doc_id, text)."""
    if slots & (slots - 1):
        raise ValueError("slots must be a power of two")
    check_model(model)
    docs = keyed_texts(docs)
    keys, counts = frequent_table(sample_texts(docs, sample_docs), model, slots)
    shared = docs.sparkSession.sparkContext.broadcast((model, keys, counts))  # 12 bytes a slot and the model
    ident = xxhash.xxh3_64_intdigest(model)

    def run(batch):
        model, keys, counts = shared.value
        if ident not in _WORKER:
            _WORKER[ident] = (load(model), {})
        sp, known = _WORKER[ident]
        raw = Texts.of(batch.column(1))
        tokens = np.zeros(batch.num_rows, np.int64)
        for a, b, t in chunks(pa.RecordBatch.from_arrays([prepared(batch.column(1))], ["text"])):
            s, e, w = pretokens(t)
            h = t.hashes(s, e).view(np.int64)
            slot = h & (slots - 1)
            n = np.where((keys[slot] == h) & (counts[slot] >= 0), counts[slot], -1).astype(np.int64)
            miss = np.flatnonzero(n < 0)
            if len(miss):
                u, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
                got = [known.get(x, -1) for x in u.tolist()]
                new = [i for i, x in enumerate(got) if x < 0]
                if new:
                    if len(known) + len(new) > cache:
                        known.clear()
                    words = [plain(t, s[miss[at[i]]], e[miss[at[i]]]) for i in new]
                    for i, k in zip(new, lengths(sp, words)):
                        got[i] = known[int(u[i])] = k
                n[miss] = np.array(got, np.int64)[back]
            tokens[a:b] = add_up(n, w)
        yield {"doc_id": batch.column(0), "n_bytes": np.diff(raw.offs), "n_tokens": tokens}

    return per_batch(docs, run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


LIMIT = 4096


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    out = count_tokens(table(spark, sf_dir, "documents"), model)
    return out.withColumn("over_limit", out.n_tokens > LIMIT)


QUERIES = {"op10_token_counts": op10_token_counts}
ORACLE: dict[str, str] = {}
