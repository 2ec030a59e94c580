"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Each task tokenises its documents and packs them itself, block by block, so
nothing is shuffled: a document longer than a sequence first fills whole
sequences, its tail joins the block. A block's tails are taken in descending
length and each goes to the sequence with the lowest estimated cost
(``linear * n + quadratic * n^2`` summed over its pieces) among those with room
for it. The block's sequences have exactly as many places as it has tokens
(full sequences, then powers of two for the rest); tails that fit nowhere whole
are cut over the gaps that remain, so a block needs no padding.

Defined results: null text is empty text (one piece, the end id); repeated rows
are packed each for itself; equal lengths keep input order; an empty table gives
no rows; other columns are ignored. Long texts use memory in proportion to one
text, never to the table.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.llm.chunks import ChunkTable, chunk_array, slices, text_bytes
from stockwise.llm.common import kept, let_go

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, sequence_cost double")
SLICE_BYTES = 2 << 20       # text tokenised at once
CACHE_CHUNKS = 200_000      # distinct chunks a worker keeps; beyond that it starts anew
BLOCK_TOKENS = 4 << 20      # tail tokens packed together


# Fixed value: the byte-level pre-tokeniser's pattern, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The vocabulary's letter of each byte: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


BYTE_OF = _byte_letters()


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*range(65, 91), *range(97, 123)]] = True
    return table


LETTER = _letters()
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def cuts(data: np.ndarray) -> np.ndarray:
    """Marks bytes before which the pre-tokeniser surely has a boundary:
    a space that a non-space follows; what follows a letter and is an ASCII
    non-letter; a letter after a single line feed. Letters are ASCII or
    Latin-1 ones; any other character is left joined to its neighbours."""
    before, after = np.zeros_like(data), np.zeros_like(data)
    before[1:], after[:-1] = data[:-1], data[1:]
    letter, space = LETTER[data], SPACE[data]
    latin = (before == 0xC3) & (data != 0x97) & (data != 0xB7)
    follows = np.zeros(len(data), bool)
    follows[1:] = (letter | latin)[:-1]
    found = (data == 32) & ~SPACE[after]
    found[-1] &= data[-1] != 32
    found |= follows & (data < 128) & ~letter & (data != 32)
    leads = letter | ((data == 0xC3) & (after != 0x97) & (after != 0xB7))
    single = np.zeros(len(data), bool)
    single[2:] = (data[1:-1] == 10) & ~space[:-2]
    return found | (leads & single)


def odd_spaces(data: np.ndarray) -> np.ndarray:
    """Places of white space outside ASCII and of the separators 1C to 1F."""
    at = np.flatnonzero(((data >= 0x1C) & (data <= 0x1F)) | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    pad = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = data[at], pad[at + 1], pad[at + 2]
    wide = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    wide |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return at[(a < 0x20) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | wide]


class ChunkEncoder:
    """Token ids of texts by encoding each distinct chunk between sure
    boundaries once. Texts with other than ASCII white space are encoded whole.
    With ``added``, added tokens get their own ids, and texts that hold one are
    encoded whole too; else they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added
        # The same merges in an engine that is quicker on short strings: byte-level BPE applies
        # merges in the order of their ids, so the vocabulary alone defines them.
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.added = sorted(special) if added else []
        ranks = {bytes(BYTE_OF[c] for c in piece): i for piece, i in self.tok.get_vocab().items() if piece not in special}
        self.quick = tiktoken.Encoding("quick", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.table = ChunkTable(self._learn, CACHE_CHUNKS)

    def _learn(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        found = [self.quick.encode_ordinary(c) for c in chunks]
        return chunks, np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts (large_string, no nulls), and the number of
        ids of each text."""
        data, bounds = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cut = cuts(data)
        cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        starts = np.flatnonzero(cut)
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(bounds, odd_spaces(data), "right") - 1] = True
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        chunks = chunk_array(data, starts)
        per_text = np.diff(np.searchsorted(starts, bounds))
        if whole.any():     # only texts that are cut need their chunks
            chunks = chunks.filter(pa.array(np.repeat(~whole, per_text)))
            per_text[whole] = 0
        flat, upto = self.table.ids(chunks)
        sizes = np.diff(upto[np.concatenate([[0], np.cumsum(per_text)])])
        if whole.any():
            pieces, done = [], 0
            for i, n in enumerate(sizes):
                if whole[i]:
                    ids = np.array(self.tok.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
                    sizes[i] = len(ids)
                    pieces.append(ids)
                else:
                    pieces.append(flat[done:done + n])
                    done += n
            flat = np.concatenate(pieces)
        return flat, sizes


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = kept("encoders")


def encoder(path: str, added: bool = False) -> ChunkEncoder:
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = ChunkEncoder(path, added)
    return _ENCODERS[path, added]


def place(lengths: np.ndarray, seq_len: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int]], list[int], np.ndarray]:
    """Pack tails shorter than ``seq_len``: pieces (tail, start, length, bin),
    and the bins' sizes and costs."""
    total = int(lengths.sum())
    caps = [seq_len] * (total // seq_len)
    rest = total % seq_len
    caps += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    room, cost = np.array(caps, np.int64), np.zeros(len(caps))
    out, aside = [], []
    for tail in np.argsort(-lengths, kind="stable"):
        n = int(lengths[tail])
        if not n:
            continue
        fits = np.where(room >= n, cost, np.inf)
        b = int(fits.argmin())
        if fits[b] == np.inf:
            aside.append((int(tail), n))
            continue
        out.append((int(tail), 0, n, b))
        room[b] -= n
        cost[b] += linear * n + quadratic * n * n
    gaps = list(np.argsort(-room, kind="stable"))
    g = 0
    for tail, n in aside:
        start = 0
        while start < n:
            while not room[gaps[g]]:
                g += 1
            b = int(gaps[g])
            k = int(min(n - start, room[b]))
            out.append((tail, start, k, b))
            room[b] -= k
            cost[b] += linear * k + quadratic * k * k
            start += k
    return out, caps, cost


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 1, linear: float = 1.0,
         quadratic: float = 1.0 / 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
         added: bool = False) -> DataFrame:
    """One row per piece: document, first id and length, CRC-32 of the piece's
    ids (little-endian unsigned 32-bit), sequence and place there; with
    ``with_ids`` also the ids. ``added``: ids as by tokenizers' plain call, in
    which added tokens in a text count; else they are ordinary text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("encoders")      # what an earlier operator's tasks left in this worker
        enc, made = encoder(tokenizer_path, added), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        block: list[tuple[int, int, int, np.ndarray]] = []     # doc, start of tail, tokens of doc, ids
        held = 0

        def emit(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found)) if found else [()] * 10
            types = [pa.int64()] * 8 + [pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int64) for x in cols[9]], pa.list_(pa.int64())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            pieces, caps, cost = place(np.array([len(x[3]) for x in block], np.int64), seq_len, linear, quadratic)
            filled, found = [0] * len(caps), []
            for tail, start, n, b in pieces:
                doc, first, total, ids = block[tail]
                part = ids[start:start + n]
                found.append((doc, first + start, n, zlib.crc32(part.tobytes()), total, made + b, filled[b], caps[b], cost[b], part))
                filled[b] += n
            made += len(caps)
            held = 0
            block.clear()
            return emit(found)

        for batch in batches:
            ids_of, texts = batch.column(0), pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for lo, hi in slices(texts, SLICE_BYTES):
                flat, sizes = enc.encode(texts.slice(lo, hi - lo))
                at, full = 0, []
                for doc, n in zip(ids_of.slice(lo, hi - lo).to_pylist(), sizes):
                    ids = np.append(flat[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    total = len(ids)
                    cut = total - total % seq_len
                    for start in range(0, cut, seq_len):
                        part = ids[start:start + seq_len]
                        full.append((doc, start, seq_len, zlib.crc32(part.tobytes()), total, made, 0, seq_len,
                                     linear * seq_len + quadratic * seq_len ** 2, part))
                        made += 1
                    if total > cut:
                        block.append((doc, cut, total, ids[cut:]))
                        held += total - cut
                if full:
                    yield emit(full)
                if held >= BLOCK_TOKENS:
                    yield flush()
        if block:
            yield flush()

    schema = SCHEMA + (", ids array<long>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(rows, schema)
