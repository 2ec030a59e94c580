"""Exact removal of repeated byte strings by winnowing anchors and window counts.

Every byte covered by a ``length``-byte string that also starts anywhere else in
the table goes. Ranking all suffixes by prefix doubling takes one row per byte;
this takes a content-defined sample of them and counts instead:

1. *Anchors.* In each window the position of the smallest 32-byte-gram hash is
   its anchor. It depends on the window's bytes alone, so equal windows have
   their anchors at the same offset. One row per anchor stands for the run of
   windows that share it (their *span*), about one row per 185 bytes.
2. *Equal spans.* Spans whose bytes occur twice are repeated in all windows.
   This collapses copies before anything is compared, by counting.
3. *Block prefixes.* For the distinct spans that share an anchor gram, blocks of
   ``length/8`` bytes to the right of the anchor, and to the left, are named by a
   byte each; equal prefixes of 1, 2, 4 and 8 names are counted. A span leaves
   when its prefix is unique; the lengths reached bound the windows that can
   still repeat. This is a filter: no ranks are sorted or joined.
4. *Windows* within those bounds are named by 95-bit hashes and counted. Grams
   with very many distinct spans are salted: a salted group of two already
   proves a repeat, only the rest is compared across salts.

Nothing is capped; no group is gathered in one task or on the driver.

Defined results: null text is empty; texts shorter than ``length`` stay whole;
two rows with equal text are copies of each other whatever their id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stockwise.llm.common import kept, let_go, stored

GRAM = 32
BLOCKS = 8                      # named blocks to each side of an anchor
BASE, BASE31, PRIME = 0x9E3779B97F4A7C15, 1103515245, (1 << 31) - 1
SLICE_BYTES = 2 << 20           # text hashed at once; a longer text alone
SALT_SPANS = 1_000              # distinct spans of a gram that one salt takes
U = np.uint64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    return rng.integers(1, 1 << 63, 256, dtype=U) | U(1), rng.integers(1, PRIME, 256, dtype=U)


TABLE64, TABLE31 = _tables()
_POWERS = kept("powers")
LEAST_POWERS = 1 << 19


def _geometric(base: int, n: int, mod: int | None = None) -> np.ndarray:
    out, k = np.ones(n + 1, U), 1
    while k <= n:
        m = min(k, n + 1 - k)
        out[k:k + m] = out[:m] * U(pow(base, k, mod or 1 << 64))
        if mod:
            out[k:k + m] %= U(mod)
        k *= 2
    return out


def powers(n: int, narrow: bool = False) -> dict:
    """Powers up to ``n`` at least, of the prime modulus too if ``narrow``."""
    size = max(LEAST_POWERS, 1 << max(0, n - 1).bit_length())
    if _POWERS.get("n", -1) < n:
        _POWERS.update(n=size, up=_geometric(BASE, size), down=_geometric(pow(BASE, -1, 1 << 64), size))
    if narrow and _POWERS.get("n31", -1) < n:
        _POWERS.update(n31=size, up31=_geometric(BASE31, size, PRIME), down31=_geometric(pow(BASE31, -1, PRIME), size, PRIME))
    return dict(_POWERS)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Prints:
    """Hashes of any segments of a byte array, from prefix sums: 64 bits, and
    31 bits by a prime modulus."""

    def __init__(self, data: np.ndarray, narrow: bool = False) -> None:
        self.p = p = powers(len(data), narrow)
        self.sum64 = np.concatenate([np.zeros(1, U), np.cumsum(TABLE64[data] * p["up"][:len(data)], dtype=U)])
        if narrow:
            self.sum31 = np.concatenate([np.zeros(1, U), np.cumsum(TABLE31[data] * p["up31"][:len(data)] % U(PRIME), dtype=U)])

    def wide(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sum64[hi] - self.sum64[lo]) * self.p["down"][lo])

    def narrow(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sum31[hi] - self.sum31[lo]) % U(PRIME) * self.p["down31"][lo] % U(PRIME)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window, by minima from both ends of blocks."""
    n = len(keys)
    blocks = np.concatenate([keys, np.full(-n % width, np.iinfo(U).max, U)]).reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n - width + 1], upto[width - 1:n])


def batches_of(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch, of ``size`` bytes of text or one longer text, with the bytes
    of their texts and where each starts and the last ends."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    start, total = 0, 0
    cutoffs = []
    for i, n in enumerate(sizes):
        if total and total + n > size:
            cutoffs.append((start, i))
            start, total = i, 0
        total += n
    if len(sizes):
        cutoffs.append((start, len(sizes)))
    for lo, hi in cutoffs:
        part = texts.slice(lo, hi - lo)
        ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        yield batch.slice(lo, hi - lo), data, ends - ends[0]


def anchor_rows(data: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchors of all windows inside texts: text number, first window (from the
    text's start), number of windows, anchor offset, gram, span print and the
    packed block names to both sides (one byte a block)."""
    n, width = len(data), length - GRAM + 1
    prints = Prints(data)
    begins, stops = ends[:-1], ends[1:]
    if n < length:
        at = np.zeros(0, np.int64)
    else:
        pos = np.arange(n - GRAM + 1, dtype=np.int64)
        bits = U(max(1, n.bit_length()))
        keys = prints.wide(pos, pos + GRAM) >> bits << bits | pos.astype(U)
        at = (window_minima(keys, width) & ((U(1) << bits) - U(1))).astype(np.int64)
    inside = np.zeros(n + 2, np.int64)
    long = stops - begins >= length
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, stops[long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:len(at)]) > 0)
    anchor = at[windows]
    head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
    first, anchor = windows[head], anchor[head]
    count = np.diff(np.append(head, len(windows)))
    text = np.searchsorted(begins, first, "right") - 1
    # the last text that starts there: empty texts before it start there too
    right, left = np.zeros(len(head), U), np.zeros(len(head), U)
    step = length // BLOCKS
    for b in range(BLOCKS):
        lo, hi = np.minimum(anchor + b * step, stops[text]), np.minimum(anchor + (b + 1) * step, stops[text])
        right = right << U(8) | prints.wide(lo, hi) >> U(56)
        lo, hi = np.maximum(anchor - (b + 1) * step, begins[text]), np.maximum(anchor - b * step, begins[text])
        left = left << U(8) | prints.wide(lo, hi) >> U(56)
    return {"text": text, "first": first - begins[text], "count": count, "before": anchor - first,
            "gram": prints.wide(anchor, anchor + GRAM), "span": prints.wide(first, first + count - 1 + length),
            "right": right, "left": left}


NO_ID = -(1 << 62)      # k1 of rows without an id


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Rows by (k1, k2): equal keys mean equal id and, but for chance, text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.struct(*carry).alias("rest")] if carry else []
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k1"), F.hash(text).alias("k2"), text.alias("text"), *rest)


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("powers")
        for batch in batches:
            for part, data, ends in batches_of(batch):
                found = anchor_rows(data, ends, length)
                at = pa.array(found["text"])
                longs = [pa.array(found[c].view(np.int64)) for c in ("gram", "span", "right", "left")]
                ints = [pa.array(found[c].astype(np.int32)) for c in ("first", "count", "before")]
                yield pa.RecordBatch.from_arrays([part.column("k1").take(at), part.column("k2").take(at), *ints, *longs],
                                                 ["k1", "k2", "first", "n_win", "before", "gram", "span", "r", "l"])
        let_go()            # the worker goes on with other operators' tasks

    return rows.where(F.octet_length("text") >= length).select("k1", "k2", "text").mapInArrow(
        run, "k1 long, k2 int, first int, n_win int, before int, gram long, span long, r long, l long")


def _ranked(spans: DataFrame, length: int) -> DataFrame:
    """(sp, most_r, most_l): bytes that a span's context to either side can at
    most share with another span of its gram. Each round counts equal prefixes of
    the packed block names, twice as long as before, and goes on with spans whose
    prefix is not unique. A last round counts the prefixes between the powers of two, so the bounds are exact to a block."""
    step, level = length // BLOCKS, 1
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).alias("names")) for c in ("r", "l")]))
    left = spans.select("sp", "gram", sides.alias("s")).select("sp", "gram", "s.*")
    reached = left.select("sp", "side", F.lit(0).alias("blocks"))

    def not_unique(rows: DataFrame) -> DataFrame:
        ranked = rows.withColumn("rank", F.expr(f"shiftrightunsigned(names, 8 * ({BLOCKS} - blocks))"))
        again = ranked.groupBy("gram", "side", "blocks", "rank").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        return ranked.join(again, ["gram", "side", "blocks", "rank"], "left_semi").drop("rank")

    between = None
    while level <= BLOCKS:
        left = stored(not_unique(left.withColumn("blocks", F.lit(level))), f"rank-{level}")
        reached = reached.unionByName(left.select("sp", "side", "blocks"))
        # whoever shares a prefix in between shares this power of two as well
        inner = list(range(level + 1, min(2 * level, BLOCKS)))
        if inner:
            more = left.withColumn("blocks", F.explode(F.array(*[F.lit(b) for b in inner])))
            between = more if between is None else between.unionByName(more)
        level *= 2
    reached = reached.unionByName(not_unique(between).select("sp", "side", "blocks"))
    most = F.max(F.col("blocks"))
    best = reached.groupBy("sp", "side").agg(F.when(most == BLOCKS, F.lit(length)).otherwise((most + 1) * step - 1).alias("most"))
    return best.groupBy("sp").agg(*[F.max(F.when(F.col("side") == c, F.col("most"))).alias(f"most_{c}") for c in ("r", "l")])


def _repeated_windows(windows: DataFrame, salted: bool) -> DataFrame:
    """Windows of spans that stand alone, whose name occurs twice. ``tag`` holds
    the salt, and in its two lowest bits whether the gram is salted and whether
    the span stands alone. Of a salted name each salt sends one row on, so the
    salts meet without the windows being shuffled again."""
    name, own = ["w", "v"], F.col("tag").bitwiseAND(1) == 1
    salt = Window.partitionBy(*name, F.shiftright("tag", 2)).orderBy("tag")
    all_of = salt.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = windows.withColumns({"n": F.count(F.lit(1)).over(all_of), "place": F.row_number().over(salt)})
    found = seen.where(own & (F.col("n") > 1)).select("k1", "k2", "at")
    if not salted:
        return found
    heads = seen.where((F.col("tag").bitwiseAND(2) == 2) & (F.col("place") == 1))
    across = heads.withColumn("salts", F.count(F.lit(1)).over(Window.partitionBy(*name)))
    return found.unionByName(across.where(own & (F.col("n") == 1) & (F.col("salts") > 1)).select("k1", "k2", "at"))


def repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of (k1, k2, text, windows) and the struct ``rest`` of columns to
    carry: the starts of the windows that repeat, as runs ``[first, last]`` in any
    order, null where there are none."""
    rows = _keyed(docs, id_col, text_col, carry or [])
    anchors = stored(_anchors(rows, length), "anchors")
    same = ["gram", "span", "n_win"]
    spans = anchors.groupBy(*same).agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("k1", "k2", "first", "before", "r", "l")).alias("one"))
    per_gram = spans.groupBy("gram").agg(F.count(F.lit(1)).alias("n_spans")).where("n_spans > 1")
    shared = stored(
        spans.join(per_gram, "gram").select(
            F.monotonically_increasing_id().alias("sp"), *same, (F.col("copies") == 1).alias("own"), "one.*",
            F.ceil(F.col("n_spans") / SALT_SPANS).cast("int").alias("salts")), "spans")
    # windows that start d bytes before the anchor: d <= left bound, length - d <= right bound
    low = F.greatest(F.lit(length) - F.col("most_r"), F.col("before") - F.col("n_win") + 1)
    high = F.least(F.col("most_l"), F.col("before"))
    open_ = (shared.join(_ranked(shared, length), "sp").withColumns({"d_low": low, "d_high": high}).where("d_low <= d_high")
             .groupBy("k1", "k2").agg(F.collect_list(F.struct(
                 (F.col("first") + F.col("before") - F.col("d_high")).alias("start"),
                 (F.col("d_high") - F.col("d_low") + 1).alias("n"), 
                 (F.pmod(F.col("sp"), F.col("salts").cast("long")).cast("int") * 4 + (F.col("salts") > 1).cast("int") * 2
                  + F.col("own").cast("int")).alias("tag"))).alias("open")))
    open_ = stored(open_, "open")
    by_key = rows.repartition("k1", "k2")

    def name_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("powers")
        for batch in batches:
            for part, data, ends in batches_of(batch):
                prints = Prints(data, narrow=True)
                lists = part.column("open")
                of = np.repeat(np.arange(len(part)), np.asarray(pc.list_value_length(lists), np.int64))
                flat = lists.flatten()
                get = lambda c: np.asarray(pc.struct_field(flat, c))
                n = get("n").astype(np.int64)
                row = np.repeat(np.arange(len(n)), n)
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + get("start")[row]
                lo = start + ends[of[row]]
                for a in range(0, len(lo), 1 << 18):
                    cut = slice(a, a + (1 << 18))
                    tag = get("tag")[row[cut]].astype(np.int32)
                    # only a span that stands alone needs its place again
                    doc = pa.array(of[row[cut]], mask=tag & 1 == 0)
                    at = np.where(tag & 1, start[cut], 0).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(prints.wide(lo[cut], lo[cut] + length).view(np.int64)),
                         pa.array(prints.narrow(lo[cut], lo[cut] + length).astype(np.int32)),
                         part.column("k1").take(doc), part.column("k2").take(doc), pa.array(at), pa.array(tag)],
                        ["w", "v", "k1", "k2", "at", "tag"])
        let_go()

    salted = shared.agg(F.max("salts")).first()[0]
    # with the carried columns both joins need the same rows by key, so the texts are shuffled once
    windows = (by_key.join(open_, ["k1", "k2"]).select(*by_key.columns, "open")
               .mapInArrow(name_windows, "w long, v int, k1 long, k2 int, at int, tag int"))
    single = _repeated_windows(windows, bool(salted and salted > 1)).select("k1", "k2", F.col("at").alias("a"), F.col("at").alias("b"))
    copied = (anchors.join(spans.where("copies > 1").select(*same), same, "left_semi")
              .select("k1", "k2", F.col("first").alias("a"), (F.col("first") + F.col("n_win") - 1).alias("b")))
    runs = single.unionByName(copied).groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("windows"))
    return by_key.join(runs, ["k1", "k2"], "left")


def _merged(runs: list[dict] | None, length: int) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return out


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    kept_text) and the struct ``rest`` of columns to carry. ``kept_text`` keeps a
    character whole if any of its bytes stays, so that it is valid text; all else
    counts bytes."""
    found = repeats(docs, length, id_col, text_col, carry)
    found = found.withColumn("doc_id", F.when(F.col("k1") != NO_ID, F.col("k1")))
    rest = found.select("rest").schema.fields if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
            for doc, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "windows"))):
                data, spans = text.encode(), _merged(runs, length)
                kept, whole, at, put = [], [], 0, 0
                for lo, hi in spans:
                    kept.append(data[at:lo])
                    at = hi
                    while lo < len(data) and data[lo] & 0xC0 == 0x80:      # the character began before the span
                        lo += 1
                    while hi < len(data) and data[hi] & 0xC0 == 0x80:      # its last character goes on after it
                        hi -= 1
                    if lo < hi:
                        whole.append(data[put:lo])
                        put = hi
                kept.append(data[at:])
                whole.append(data[put:])
                out["doc_id"].append(doc)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(b"".join(kept)).hexdigest())
                out["kept_text"].append(b"".join(whole).decode())
            types = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types)]
            yield pa.RecordBatch.from_arrays(arrays + [batch.column(f.name) for f in rest], [*out, *["rest"] * len(rest)])

    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()),
        ("kept_sha256", T.StringType()), ("kept_text", T.StringType()))] + list(rest))
    return found.select("doc_id", "text", "windows", *[f.name for f in rest]).mapInArrow(run, schema)
