"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a
single-pass Viterbi search.

The automaton reads a pre-token once; at each position its output links give all pieces
that end there, longest first, and each relaxes the best score of that position. Scores
are the model's stored piece scores (the best path is that of the model read as a unigram
model; the library's merge order of a BPE model gives other ids for part of the words).
A character without a piece of its own may be taken as unknown, at the lowest score less
ten, and becomes the byte pieces of its UTF-8 bytes. Ties go to the longer last piece.

A text is cut before each run of spaces, which no piece crosses (checked by check_model),
so the best path of the text is the best paths of the parts in a row. Each chunk of text
encodes its distinct pre-tokens once; a bounded cache in each worker keeps their ids.

Null and empty texts have no ids; empty ids decode to the empty text. A literal space
mark in a text decodes as a space (as in the library). Unknown ids (0) decode to U+2047
between spaces, control ids to nothing, invalid UTF-8 of byte pieces to U+FFFD; ids
outside the vocabulary are an error.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from scorebook.llm.frames import keyed_texts, per_batch, table
from scorebook.llm.token_counts import MARK, check_model, prepared, pretokens
from scorebook.llm.words import Texts, chunks, ragged

CACHE = 1 << 17
UNKNOWN_PENALTY = 10
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model file

#: Per Python worker: model -> codec; lives across tasks.
_WORKER: dict[int, "Codec"] = {}


class Codec:
    def __init__(self, model: bytes, cache: int = CACHE):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(model)
        self.cache, self.known = cache, {}
        self.trie, self.single, self.byte_ids = ahocorasick.Automaton(), set(), np.full(256, -1, np.int32)
        out, low = [], 0.0
        for i, p in enumerate(m.pieces):
            if p.type == NORMAL:
                self.trie.add_word(p.piece, (len(p.piece), p.score, i))
                low = min(low, p.score)
                if len(p.piece) == 1:
                    self.single.add(p.piece)
                out.append(p.piece.replace(MARK, " ").encode())
            elif p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                out.append(bytes([int(p.piece[3:5], 16)]))
            else:
                out.append(" ⁇ ".encode() if p.type == UNKNOWN else b"")
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte fallback; unknown characters could not be decoded")
        self.trie.make_automaton()
        self.unknown = low - UNKNOWN_PENALTY
        self.piece_buf = np.frombuffer(b"".join(out), np.uint8)
        self.piece_lens = np.array([len(x) for x in out], np.int64)
        self.piece_starts = np.cumsum(self.piece_lens) - self.piece_lens

    def encode_part(self, part: str) -> list[int]:
        """Ids of one string with space marks in place of spaces."""
        n = len(part)
        best = [0.0] + [-np.inf] * n
        back = [None] * (n + 1)
        odd = [i for i, c in enumerate(part) if c not in self.single]
        k = 0
        for end, (size, score, piece) in self.trie.iter(part):
            while k < len(odd) and odd[k] < end:
                self._relax_unknown(best, back, odd[k])
                k += 1
            v = best[end + 1 - size] + score
            if v > best[end + 1]:
                best[end + 1] = v
                back[end + 1] = (size, piece)
        for i in odd[k:]:
            self._relax_unknown(best, back, i)
        ids, at = [], n
        while at:
            size, piece = back[at]
            if piece < 0:
                ids.extend(self.byte_ids[list(part[at - 1].encode())].tolist()[::-1])
            else:
                ids.append(piece)
            at -= size
        return ids[::-1]

    def _relax_unknown(self, best, back, i):
        v = best[i] + self.unknown
        if v > best[i + 1]:
            best[i + 1] = v
            back[i + 1] = (1, -1)

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (prepared) texts in a row, and offsets per text."""
        s, e, w = pretokens(t)
        u, at, back = np.unique(t.hashes(s, e), return_index=True, return_inverse=True)
        keys, known = u.tolist(), self.known
        ids = [known.get(x) for x in keys]
        new = [i for i, x in enumerate(ids) if x is None]
        if len(known) + len(new) > self.cache:
            known.clear()
        for i in new:
            j = at[i]
            part = t.buf[s[j]:e[j]].tobytes().decode().replace(" ", MARK)
            ids[i] = known[keys[i]] = np.array(self.encode_part(part), np.int32).tobytes()
        lens = np.array([len(x) >> 2 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), np.int32)
        starts, n = (np.cumsum(lens) - lens)[back], lens[back]
        ends = np.concatenate([[0], np.cumsum(n)])
        return flat[ragged(starts, n)], ends[w]

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> pa.Array:
        """Texts of rows of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.piece_lens)):
            raise ValueError("an id is outside the vocabulary")
        n = self.piece_lens[ids]
        buf = self.piece_buf[ragged(self.piece_starts[ids], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[offs]
        first = ends[:-1].copy()
        some = np.flatnonzero(ends[1:] > first)
        first[some] += buf[first[some]] == 0x20  # the space that encoding put in front
        lens = ends[1:] - first
        buf = np.ascontiguousarray(buf[ragged(first, lens)])
        offs = np.concatenate([[0], np.cumsum(lens)])
        out = pa.Array.from_buffers(pa.large_binary(), len(lens),
                                    [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(buf)])
        try:
            return out.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.as_py().decode("utf-8", "replace") for x in out], pa.string())


def codec(model: bytes) -> Codec:
    ident = xxhash.xxh3_64_intdigest(model)
    if ident not in _WORKER:
        _WORKER[ident] = Codec(model)
    return _WORKER[ident]


def _list_array(ids: np.ndarray, offs: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids of every row of `docs` (doc_id, text)."""
    check_model(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file, of fixed size

    def run(batch):
        for a, b, t in chunks(pa.RecordBatch.from_arrays([prepared(batch.column(1))], ["text"])):
            yield {"doc_id": batch.column(0).slice(a, b - a), "ids": _list_array(*codec(shared.value).encode(t))}

    return per_batch(keyed_texts(docs), run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id, text of every row of `encoded` (doc_id, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        for a in range(0, batch.num_rows, 256):
            ids = batch.column(1).slice(a, 256)
            n = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            offs = np.concatenate([[0], np.cumsum(n)])
            yield {"doc_id": batch.column(0).slice(a, 256), "text": codec(shared.value).decode(flat, offs)}

    return per_batch(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def encode_report(docs: DataFrame, model: bytes) -> DataFrame:
    """Encodes and decodes every row: doc_id, n_bytes, n_tokens, ids_sha256 (of the ids as little-endian int32),
    decoded_sha256 (of the decoded text) and round_trip (whether that is the text; null counts as empty)."""
    check_model(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        c, raw = codec(shared.value), Texts.of(batch.column(1))
        for a, b, t in chunks(pa.RecordBatch.from_arrays([prepared(batch.column(1))], ["text"])):
            ids, offs = c.encode(t)
            little = ids.astype("<i4")
            back = Texts.of(c.decode(ids, offs))
            texts = [back.bytes_of(i) for i in range(len(back))]
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_bytes": np.diff(raw.offs[a:b + 1]),
                   "n_tokens": np.diff(offs),
                   "ids_sha256": [hashlib.sha256(little[x:y].tobytes()).hexdigest() for x, y in zip(offs, offs[1:])],
                   "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in texts],
                   "round_trip": [x == raw.bytes_of(a + i) for i, x in enumerate(texts)]}

    return per_batch(keyed_texts(docs), run, "doc_id bigint, n_bytes bigint, n_tokens bigint, ids_sha256 string, "
                                             "decoded_sha256 string, round_trip boolean")


def vocabulary() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_report(table(spark, sf_dir, "documents"), vocabulary())


QUERIES = {"op6_sentencepiece": op6_sentencepiece}
ORACLE: dict[str, str] = {}
