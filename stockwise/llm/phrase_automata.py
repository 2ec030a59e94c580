"""Exact removal of repeated word windows by automata of recurring phrases.

A window is ``length`` consecutive words of one document. Each word covered by a
window whose words also start earlier (in a document of smaller id, or earlier in
the same one) goes. Documents are dealt into blocks of about ``BLOCK_BYTES``:

1. *Phrases.* The smallest hash among a window's eight-word phrases is its anchor;
   it depends on the window's words alone, so equal windows have the same one.
   Anchors, about one in seven words, are counted over all documents; only those
   that stand twice can lie in a repeated window.
2. *Passages confirmed.* Windows with a recurring anchor are named by 95-bit
   hashes and counted over all blocks, one row a name and block, with the document
   that has it first.
3. *Automata.* A block's shard holds the phrases of its confirmed windows, one
   letter of 64 a word. All documents of the block are streamed through it as such
   letters; windows around the phrases found are looked up among the block's
   confirmed ones, and each occurrence but the first place is removed.

Each shard is as large as its block's own repeats, so work and memory grow with
the input and no automaton is sent to all tasks. Texts are shuffled by block
twice. A name that stands in every block makes one row a block, never one a copy.

Defined results: null text has no words; texts shorter than a window stay whole;
rows of one id are in an order that hashes of their texts give, null ids come last;
of rows equal in id and text one keeps its words; an empty table gives no rows; other
columns are ignored. Rows equal in both id and text meet in one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwise.llm.common import stored
from stockwise.llm.suffix_dedup import PRIME, Prints, batches_of, mix, powers, window_minima

PHRASE = 8                      # words of an anchor phrase
BLOCK_BYTES = 2 << 20           # text of a block
HASHED = 1 << 17                # words hashed at once
PLACE = 28                      # low bits of a phrase's key that hold its place
LETTER_BITS = 6
LETTERS = np.frombuffer(bytes(range(48, 48 + (1 << LETTER_BITS))), np.uint8)
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """Words of the texts in ``data`` (text i from ``ends[i]`` to ``ends[i + 1]``):
    byte bounds, text number, hash, and the first word of each text."""

    def __init__(self, data: np.ndarray, ends: np.ndarray) -> None:
        self.data, self.ends = data, ends
        solid = ~SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[ends] = True
        before = np.concatenate([[False], solid[:-1]])
        after = np.concatenate([solid[1:], [False]])
        self.lo = np.flatnonzero(solid & (cut[:-1] | ~before[:len(solid)]))
        self.hi = np.flatnonzero(solid & (cut[1:] | ~after[:len(solid)])) + 1
        self.first = np.searchsorted(self.lo, ends)
        self.text = np.repeat(np.arange(len(ends) - 1), np.diff(self.first))
        self.hash = np.zeros(len(self.lo), U)
        for a in range(0, len(self.lo), HASHED):
            part = slice(a, a + HASHED)
            at = self.lo[a]
            prints = Prints(data[at:self.hi[part][-1]])
            self.hash[part] = prints.wide(self.lo[part] - at, self.hi[part] - at)

    def __len__(self) -> int:
        return len(self.lo)

    def windows(self, length: int) -> np.ndarray:
        """Starts of all windows."""
        sizes = np.maximum(np.diff(self.first) - length + 1, 0)
        return np.arange(sizes.sum()) + np.repeat(self.first[:-1] - np.cumsum(sizes) + sizes, sizes)

    def runs(self, width: int) -> "Runs":
        return Runs(self.hash, width)


class Runs:
    """Hashes of runs of ``width`` words, by their starts."""

    def __init__(self, hashes: np.ndarray, width: int) -> None:
        self.width, self.p = width, powers(len(hashes))
        self.sum64 = np.concatenate([np.zeros(1, U), np.cumsum(hashes * self.p["up"][:len(hashes)], dtype=U)])
        self.hashes, self.sum31 = hashes, None

    def wide(self, at: np.ndarray) -> np.ndarray:
        return mix((self.sum64[at + self.width] - self.sum64[at]) * self.p["down"][at])

    def narrow(self, at: np.ndarray) -> np.ndarray:
        if self.sum31 is None:
            self.p = powers(len(self.hashes), narrow=True)
            self.sum31 = np.concatenate([np.zeros(1, U), np.cumsum(self.hashes % U(PRIME) * self.p["up31"][:len(self.hashes)] % U(PRIME), dtype=U)])
        return (self.sum31[at + self.width] - self.sum31[at]) % U(PRIME) * self.p["down31"][at] % U(PRIME)


def anchored(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the place of each one's anchor phrase, and the phrase's hash."""
    windows = words.windows(length)
    if not len(windows):
        return windows, windows, np.zeros(0, U)
    pos = np.arange(len(words) - PHRASE + 1)
    names = words.runs(PHRASE).wide(pos)
    keys = names >> U(PLACE) << U(PLACE) | pos.astype(U)
    anchor = (window_minima(keys, length - PHRASE + 1)[windows] & U((1 << PLACE) - 1)).astype(np.int64)
    return windows, anchor, names[anchor]


def heads(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate([[True], change]))


def _phrases(rows: DataFrame, length: int) -> DataFrame:
    """(block, phrase): anchor phrases that stand twice in the table, by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, ends in batches_of(batch):
                words = Words(data, ends)
                _, anchor, phrase = anchored(words, length)
                one = heads(anchor)
                phrase, block = phrase[one].view(np.int64), np.asarray(part.column("block"))[words.text[anchor[one]]]
                order = np.lexsort((block, phrase))
                phrase, block = phrase[order], block[order]
                first = heads(phrase, block)
                n = np.diff(np.append(first, len(phrase)))
                yield pa.RecordBatch.from_arrays([pa.array(phrase[first]), pa.array(block[first]), pa.array(n.astype(np.int32))], ["phrase", "block", "n"])

    found = rows.select("block", "text").mapInArrow(run, "phrase long, block int, n int").repartition("phrase")
    found = found.groupBy("phrase", "block").agg(F.sum("n").alias("n"))
    return found.withColumn("all", F.sum("n").over(Window.partitionBy("phrase"))).where(F.col("all") > 1).select("block", "phrase")


def _block(table: pa.Table) -> tuple[pa.Table, Words]:
    """A block's documents in their order, and their words."""
    order = np.lexsort((np.asarray(table.column("h")), np.asarray(table.column("k")), np.asarray(table.column("none"))))
    table = table.take(order)
    texts = table.column("text").combine_chunks().cast(pa.large_binary())
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return table, Words(data, ends - ends[0])


def letters(words: Words) -> np.ndarray:
    return (words.hash >> U(64 - LETTER_BITS)).astype(np.int64)


WINDOWS = "block int, w long, v int, n int, none boolean, k long, phrase long"


def _confirmed(rows: DataFrame, phrases: DataFrame, length: int) -> DataFrame:
    """(block, w, phrase, here): names of the windows that stand twice in the table
    and, in this block, not only at their first place; ``here`` tells whether that
    place is in this block."""
    def run(docs: pa.Table, recurring: pa.Table) -> pa.Table:
        if not docs.num_rows or not recurring.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _types(WINDOWS)})
        table, words = _block(docs)
        at, anchor, name = anchored(words, length)
        known = np.sort(np.asarray(recurring.column("phrase")))
        name = name.view(np.int64)
        hit = known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name
        at, anchor = at[hit], anchor[hit]
        runs = words.runs(length)
        w, v = runs.wide(at).view(np.int64), runs.narrow(at).astype(np.int32)
        order = np.lexsort((at, v, w))
        w, v, at, anchor = w[order], v[order], at[order], anchor[order]
        first = heads(w, v)
        n = np.diff(np.append(first, len(w)))
        at, anchor = at[first], anchor[first]
        code, spelled = letters(words), np.zeros(len(at), np.int64)
        for i in range(PHRASE):
            spelled = spelled << LETTER_BITS | code[anchor + i]
        text = pa.array(words.text[at])
        return pa.table({
            "block": table.column("block").take(text), "w": w[first], "v": v[first], "n": n.astype(np.int32),
            "none": table.column("none").take(text), "k": table.column("k").take(text), "phrase": spelled})

    windows = rows.groupBy("block").cogroup(phrases.groupBy("block")).applyInArrow(run, WINDOWS)
    same = Window.partitionBy("w", "v")
    place = F.struct("none", "k", "block")       # inside a block the order of its documents holds
    seen = windows.select("block", "w", "v", "n", "phrase", F.min(place).over(same)["block"].alias("home"), F.sum("n").over(same).alias("all"))
    here = F.col("home") == F.col("block")
    return seen.where((F.col("all") > 1) & ~(here & (F.col("n") == 1))).select("block", "w", "phrase", here.alias("here"))


def _types(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return [(c, kinds[t]) for c, t in (x.split() for x in schema.split(", "))]


def automaton(phrases: np.ndarray) -> ahocorasick.Automaton:
    """One of the phrases spelled in ``phrases``, six bits a letter."""
    made = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    shifts = np.arange(PHRASE - 1, -1, -1) * LETTER_BITS
    spelled = LETTERS[(phrases[:, None] >> shifts) & ((1 << LETTER_BITS) - 1)].tobytes().decode("ascii")
    for i in range(0, len(spelled), PHRASE):
        made.add_word(spelled[i:i + PHRASE])
    made.make_automaton()
    return made


def located(words: Words, known: pa.Table, length: int) -> np.ndarray:
    """Starts of the windows to remove: all occurrences of the names in ``known``
    near a phrase that the automaton finds, but for first places."""
    if not known.num_rows or len(words) < length:
        return np.zeros(0, np.int64)
    stream = LETTERS[letters(words)].tobytes().decode("ascii")
    shard = automaton(np.unique(np.asarray(known.column("phrase"))))
    found = np.fromiter((end for end, _ in shard.iter(stream)), np.int64) - PHRASE + 1
    near = np.zeros(len(words) + length + 1, np.int32)
    np.add.at(near, np.maximum(found - length + PHRASE, 0), 1)
    np.add.at(near, found + 1, -1)
    windows = words.windows(length)
    windows = windows[np.cumsum(near)[windows] > 0]
    name = words.runs(length).wide(windows).view(np.int64)
    names, here = np.asarray(known.column("w")), np.asarray(known.column("here"))
    order = np.argsort(names, kind="stable")
    names, here = names[order], here[order]
    place = np.minimum(np.searchsorted(names, name), len(names) - 1)
    hit = names[place] == name
    windows, place = windows[hit], place[hit]
    _, first = np.unique(place, return_index=True)
    stays = np.zeros(len(windows), bool)
    stays[first] = here[place[first]]
    return windows[~stays]


KEPT = "doc_id long, n_words long, n_removed long, n_spans long, kept_text string"


def remove_repeated_windows(docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_words, n_removed, n_spans, kept_text), the
    kept words joined by one space; spans are runs of removed words."""
    if length < PHRASE:
        raise ValueError(f"windows of fewer than {PHRASE} words hold no anchor phrase")
    text, key = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("long")
    rows = docs.select(key.isNull().alias("none"), F.coalesce(key, F.lit(0)).alias("k"), F.xxhash64(text).alias("h"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = rows.withColumn("block", F.pmod(F.xxhash64("none", "k", "h"), F.lit(size // BLOCK_BYTES + 1)).cast("int"))
    phrases = stored(_phrases(rows, length), "phrases")
    known = stored(_confirmed(rows, phrases, length), "passages")

    def run(group: pa.Table, confirmed: pa.Table) -> pa.Table:
        table, words = _block(group)
        covered = np.zeros(len(words) + 1, np.int64)
        gone = located(words, confirmed, length)
        np.add.at(covered, gone, 1)
        np.add.at(covered, gone + length, -1)
        removed = np.cumsum(covered[:-1]) > 0
        opens = removed & ~np.concatenate([[False], removed[:-1]])[:len(removed)]
        opens |= removed & np.isin(np.arange(len(words)), words.first)
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[words.first])
        # kept bytes, each word with one space behind it
        sizes = np.where(removed, 0, words.hi - words.lo + 1)
        stop = np.cumsum(sizes)
        out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
        kept = ~removed
        lengths = (words.hi - words.lo)[kept]
        step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[step + np.repeat((stop - sizes)[kept], lengths)] = words.data[step + np.repeat(words.lo[kept], lengths)]
        bounds = np.concatenate([[0], stop])[words.first]
        joined = out.tobytes()
        texts = [joined[a:b - 1].decode() if b > a else "" for a, b in zip(bounds[:-1], bounds[1:])]
        none, k = np.asarray(table.column("none")), np.asarray(table.column("k"))
        return pa.table({
            "doc_id": pa.array(k, mask=none), "n_words": np.diff(words.first), "n_removed": total(removed),
            "n_spans": total(opens), "kept_text": pa.array(texts, pa.string())})

    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, KEPT)
