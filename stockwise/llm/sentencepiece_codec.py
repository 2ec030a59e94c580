"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

The segmentation of a word is the one whose pieces have the largest sum of
scores; ties take the longer last piece. Words are coded once per batch, and words
of equal length advance together: at each end position the candidates of all
lengths are probed at once, by hashes of their bytes, in the sorted hashes of the
pieces; a vectorised maximum keeps score and backpointer. Characters without a
piece fall back to byte pieces, so any text is coded and decoding restores it
exactly. Pieces never span words (a word starts at a space mark), as in the models
the format is used for.

The pieces and scores come from a model file, a parameter. The given model was
trained by merges; its scores are negative merge ranks. Sums of ranks mean little,
so ranks become log-probabilities by the Zipf-Mandelbrot law, ``-log(rank + 100)``.
The best segmentation need not be the one that the merges would build.

Defined results: null text is empty and has no ids; a space mark inside a text is
coded by byte pieces, so it survives; repeated rows are coded each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.llm.chunks import ChunkTable, chunk_array, ragged, slices, text_bytes
from stockwise.llm.common import kept, let_go
from stockwise.llm.suffix_dedup import Prints

U = np.uint64
SPACE = "▁"
BYTE_SCORE = -1e6       # a byte piece is taken only where no piece fits
SENTINEL = -1e8
FILTER_BITS = 20
RANK_SHIFT = 100        # of the logarithm that makes merge ranks probabilities
CACHE_WORDS = 800_000


class Codec:
    """Pieces of a model, and the words coded so far."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i).encode() for i in range(model.get_piece_size())]
        self.bytes_of = np.zeros(256, np.int64)
        normal = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                b = int(piece[1:-1], 16)
                self.bytes_of[b] = i
                self.pieces[i] = bytes([b])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.pieces[i] = b""
            else:
                normal.append(i)
        # pieces with space marks after other characters would span words
        mark = SPACE.encode()
        normal = [i for i in normal if mark not in self.pieces[i][1:]]
        joined = np.frombuffer(b"".join(self.pieces[i] for i in normal), np.uint8)
        size = np.array([len(self.pieces[i]) for i in normal], np.int64)
        ends = np.cumsum(size)
        keys = Prints(joined).wide(ends - size, ends) if normal else np.zeros(0, U)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)       # spares most of the probes
        self.maybe[self.keys >> U(64 - FILTER_BITS)] = True
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        self.ids = np.array(normal, np.int64)[order]
        scores = np.array([model.get_score(i) for i in normal])[order]
        # pieces that no merge makes carry a sentinel instead of a rank: they rank last
        ranked = scores > SENTINEL
        scores = np.where(ranked, scores, scores[ranked].min(initial=0.0) - 1)
        self.scores = -np.log(RANK_SHIFT - scores) if (scores == np.round(scores)).all() else scores
        self.longest = int(size.max(initial=1))
        # what an id stands for: a mark is a space, but not where byte pieces spell it
        plain = [p.replace(mark, b" ") for p in self.pieces]
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_ends = np.concatenate([[0], np.cumsum([len(p) for p in plain])])
        self.table = ChunkTable(self._learn, CACHE_WORDS)

    def _learn(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Ids of chunks in which a space stands for a mark; chunks of one length
        go together."""
        mark = SPACE.encode()
        by_size: dict[int, tuple[list[str], list[bytes]]] = {}
        odd = []
        for chunk in chunks:
            word = chunk.encode()
            if mark in word:
                odd.append(chunk)
                continue
            word = word.replace(b" ", mark)
            group = by_size.setdefault(len(word), ([], []))
            group[0].append(chunk)
            group[1].append(word)
        order, flat, count = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for n, (names, words) in by_size.items():
            step = max(1, (1 << 20) // max(n, 1))
            for a in range(0, len(words), step):
                ids, k = self._viterbi(words[a:a + step], n)
                order += names[a:a + step]
                flat.append(ids)
                count.append(k)
        spelled = self.bytes_of[np.frombuffer(mark, np.uint8)]
        for chunk in odd:       # a mark of the text itself is spelled by byte pieces
            parts = []
            for i, word in enumerate(chunk.encode().split(mark)):
                parts += [spelled] * (i > 0) + [self._viterbi([word.replace(b" ", mark)], len(word.replace(b" ", mark)))[0]]
            order.append(chunk)
            flat.append(np.concatenate(parts))
            count.append(np.array([len(flat[-1])]))
        return order, np.concatenate(flat), np.concatenate(count)

    def _viterbi(self, group: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
        k = len(group)
        data = np.frombuffer(b"".join(group), np.uint8)
        prints, base = Prints(data), np.arange(k) * n
        best = np.full((n + 1, k), -np.inf)
        best[0] = 0
        back, used = np.zeros((n + 1, k), np.int32), np.zeros((n + 1, k), np.int64)
        for end in range(1, n + 1):
            # the fall-back: one byte
            score, step, piece = best[end - 1] + BYTE_SCORE, np.ones(k, np.int32), self.bytes_of[data[base + end - 1]]
            for size in range(1, min(end, self.longest) + 1):
                key = prints.wide(base + end - size, base + end)
                some = np.flatnonzero(self.maybe[key >> U(64 - FILTER_BITS)])
                if not len(some):
                    continue
                at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
                total = best[end - size, some] + self.scores[at]
                better = (self.keys[at] == key[some]) & (total >= score[some])
                some, at = some[better], at[better]
                score[some], step[some], piece[some] = total[better], size, self.ids[at]
            best[end], back[end], used[end] = score, step, piece
        # all words walk back together
        at, out = np.full(k, n), []
        rows = np.arange(k)
        while (at > 0).any():
            out.append(np.where(at > 0, used[at, rows], -1))
            at = np.where(at > 0, at - back[at, rows], 0)
        if not out:
            return np.zeros(0, np.int64), np.zeros(k, np.int64)
        ids = np.stack(out[::-1], 1)
        return ids[ids >= 0], (ids >= 0).sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (large_string, no nulls) joined, and where each
        text's start and the last end. A space becomes the mark that starts the
        next word; one mark leads each text, unless it is empty."""
        lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", texts.type), pa.scalar(" ", texts.type))
        data, bounds = text_bytes(pc.binary_join_element_wise(lead, texts, pa.scalar("", texts.type)))
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        cut = (data == 32) | (data == 10)
        cut[1:] |= data[:-1] == 10
        starts = np.flatnonzero(cut)
        flat, upto = self.table.ids(chunk_array(data, starts))
        return flat, upto[np.searchsorted(starts, bounds)]

    def decode(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of joined ids (large_string)."""
        raw, upto = ragged(self.plain, self.plain_ends, flat.astype(np.int64))
        bounds = upto[ends]
        keep = np.ones(len(raw), bool)
        keep[bounds[:-1][bounds[:-1] < bounds[1:]]] = False        # the lead
        cuts = np.concatenate([[0], np.cumsum(keep)])[bounds]
        return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(cuts), pa.py_buffer(raw[keep]))


_CODECS: dict[str, Codec] = kept("codecs")


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, ids); with ``digest`` (doc_id, n_pieces, ids_crc32, decoded_equal)
    instead, where ids were decoded again and compared with the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("codecs", "powers")
        c = codec(model_path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for lo, hi in slices(texts, 8 << 20):
                part = texts.slice(lo, hi - lo)
                doc = batch.column(0).slice(lo, hi - lo)
                flat, ends = c.encode(part)
                if digest:
                    raw = flat.astype("<u4")
                    crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [doc, pa.array(np.diff(ends)), pa.array(crc, pa.int64()), pc.equal(c.decode(flat, ends), part)],
                        ["doc_id", "n_pieces", "ids_crc32", "decoded_equal"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [doc, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_equal boolean" if digest else "doc_id long, ids array<int>")


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("codecs", "powers")
        c = codec(model_path)
        for batch in batches:
            lists = batch.column(1)
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))])
            texts = c.decode(np.asarray(lists.flatten(), np.int64), ends)
            texts = pc.if_else(lists.is_null(), pa.scalar(None, texts.type), texts).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
