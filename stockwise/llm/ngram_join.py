"""Near-duplicate join on word shingles with a count-vector R-tree.

A text's set holds its distinct shingles (64-bit hashes of ``width`` lower-cased
words). Two sets link when their Jaccard similarity reaches the threshold; the
result is the link components.

1. Equal sets become one (digest of the sorted set), so exact copies cost a row.
2. *Routing.* Linked sets must share a shingle among their first
   ``n - ceil(t n) + 1`` in any order common to all. The order puts shingles of
   hash buckets that a count sketch finds frequent last, so shared passages rarely
   route; the sketch only orders, it drops nothing. It has buckets in proportion to
   the text: a full one finds nothing frequent, and shared passages would tie
   documents to ever larger clusters. Only its frequent buckets leave the tasks. Routed
   shingles of few sets give pairs, kept if enough of them are common; those of
   many give stars. Every link lies inside a component of these edges (cluster).
3. *Count-vector R-tree.* In a cluster, a set's shingles are hashed into 64
   groups; the group counts are its point. Points are packed into leaves, the
   leaf's coordinate maxima bound its points: the summed minima of two points
   (or a point and a leaf) bound the overlap from above. Surviving pairs are
   verified on the sets themselves, except where both already are in one
   component, as copies of copies need no further links.
4. A cluster of more sets than a block holds is cut by size class and hash. All
   blocks first meet a few pivots of the cluster, which joins one big family;
   after that only sets outside the largest component meet the other blocks.

Defined results: null text and text without words have an empty set, which links
with nothing; a text of fewer words than ``width`` has its whole sequence as one
shingle; ties take the smallest id; repeated rows are equal sets; an empty table
gives no rows; other columns are ignored. Ids name documents: rows of one id with
different texts count as connected.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwise.llm.common import let_go, stored
from stockwise.llm.components import connected_components
from stockwise.llm.suffix_dedup import Prints, batches_of, mix
from stockwise.session import shuffles_freed

U = np.uint64
BUCKET_BITS = (23, 28)  # of the count sketch that orders shingles, fewest and most
BUCKET_LOAD = 32        # shingles of a bucket on average, at most: else frequent ones do not stand out
WORD_BYTES = 6          # of a shingle's text, to size the sketch
RANGE_BITS = 16         # buckets of one row of the sketch
COUNTED = 1 << 20       # shingles that a task holds before it sends their counts on
GROUPS = (64, 1024)     # coordinates of a point, fewest and most
LEAF = 32               # points of a leaf
FEW = 32                # sets of a routed shingle that are paired
BLOCK = 2000            # sets that a task compares at once
PIVOTS = 4
SLICE = 1 << 19         # bytes of text hashed at once; a longer text alone
SALT = 100_000          # rows of a routed shingle that one salt takes
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], U) | U(1)


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWERED = _lower()
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    n_texts = len(ends) - 1
    if not len(data):
        return [np.zeros(0, U)] * n_texts
    data = LOWERED[data]
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    after, before = np.append(word, False), np.append(False, word)
    starts = np.flatnonzero(after & (~before | edge))
    stops = np.flatnonzero(before & (~after | edge))
    words = Prints(data).wide(starts, stops)
    first = np.searchsorted(starts, ends)              # first word of each text
    factors = np.resize(FACTORS, width) * (U(2) * np.arange(1, width + 1, dtype=U) - U(1))
    total = np.zeros(max(0, len(words) - width + 1), U)
    for k in range(width):
        total += words[k:len(words) - width + 1 + k] * factors[k]
    hashes = mix(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            one = np.sort(hashes[a:b - width + 1])
            out.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
        elif b > a:
            short = (words[a:b] * factors[:b - a]).sum(dtype=U) + U(b - a)
            out.append(mix(np.array([short], U)))
        else:
            out.append(np.zeros(0, U))
    return out


def _digest(one: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(one.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def bits_for(rows: DataFrame) -> int:
    """Of the sketch: buckets in proportion to the bytes of text."""
    shingles = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / WORD_BYTES
    return min(BUCKET_BITS[1], max(BUCKET_BITS[0], math.ceil(math.log2(max(1.0, shingles / BUCKET_LOAD)))))


def _profile(docs: DataFrame, width: int, bits: int = BUCKET_BITS[0]) -> DataFrame:
    """A row per text (id, n, f1, f2), and per some millions of a task's shingles their
    counts by hash bucket, in ranges of buckets: places in the range and counts, compressed."""
    names = ["doc_id", "n", "f1", "f2", "bucket", "hits"]
    types = [pa.int64()] * 5 + [pa.binary()]

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, hits = np.unique(np.concatenate(held or [np.zeros(0, np.uint32)]), return_counts=True)
        ranges, first = np.unique(found >> np.uint32(RANGE_BITS), return_index=True)
        rows = []
        for at, one in zip(np.split(found, first[1:]), np.split(hits, first[1:])):
            if len(at):
                steps = np.diff(at, prepend=at[0] >> np.uint32(RANGE_BITS) << np.uint32(RANGE_BITS)).astype(np.uint16)
                rows.append(pa.compress(steps.tobytes() + one.astype(np.uint32).tobytes(), codec="zstd", asbytes=True))
        blank = pa.nulls(len(rows), pa.int64())
        sized = [len(x).to_bytes(4, "little") for x in np.split(found, first[1:]) if len(x)]
        return pa.RecordBatch.from_arrays(
            [blank] * 4 + [pa.array(ranges[:len(rows)].astype(np.int64), types[4]), pa.array([a + b for a, b in zip(sized, rows)], types[5])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("powers")
        held: list[np.ndarray] = []
        for batch in batches:
            for part, data, ends in batches_of(batch, size=SLICE):
                sets = shingle_sets(data, ends, width)
                held.append((np.concatenate(sets) >> U(64 - bits)).astype(np.uint32))
                f = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([x[0] for x in f], pa.int64()),
                     pa.array([x[1] for x in f], pa.int64()), pa.nulls(len(sets), types[4]), pa.nulls(len(sets), types[5])], names)
                if sum(map(len, held)) >= COUNTED:
                    yield counted(held)
                    held = []
        yield counted(held)

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, bucket long, hits binary")


def _sketch(profile: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent buckets, ascending, and their counts: ranges are summed in tasks,
    of which only what stands out of its chance comes to the driver."""
    size = 1 << RANGE_BITS
    mean = (profile.where("bucket is null").agg(F.sum("n")).first()[0] or 0) / (1 << bits)
    least = max(8.0, mean + 4 * math.sqrt(mean))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = -1, np.zeros(size, np.int64)

        def done() -> pa.RecordBatch:
            at = np.flatnonzero(sums > least)
            return pa.RecordBatch.from_arrays([pa.array(now * size + at, pa.int64()), pa.array(sums[at], pa.int64())], ["bucket", "hits"])

        for batch in batches:
            for r, hits in zip(batch.column("bucket").to_pylist(), batch.column("hits").to_pylist()):
                if r != now:
                    yield done()
                    now, sums = r, np.zeros(size, np.int64)
                n = int.from_bytes(hits[:4], "little")
                raw = pa.decompress(hits[4:], decompressed_size=6 * n, codec="zstd", asbytes=True)
                sums[np.cumsum(np.frombuffer(raw[:2 * n], np.uint16), dtype=np.int64)] += np.frombuffer(raw[2 * n:], np.uint32)
        yield done()

    ranges = profile.where("bucket is not null").select("bucket", "hits").repartition("bucket").sortWithinPartitions("bucket")
    with shuffles_freed(profile.sparkSession):
        found = ranges.mapInArrow(total, "bucket long, hits long").toArrow()
    buckets, counts = (np.asarray(found.column(c).combine_chunks()) for c in ("bucket", "hits"))
    order = np.argsort(buckets)
    return buckets[order].astype(np.uint32), counts[order]


def _at(buckets: np.ndarray, values: np.ndarray, asked: np.ndarray, other: int) -> np.ndarray:
    """The value of each asked bucket, ``other`` for those not listed."""
    if not len(buckets):
        return np.full(len(asked), other, values.dtype)
    at = np.minimum(np.searchsorted(buckets, asked), len(buckets) - 1)
    return np.where(buckets[at] == asked, values[at], values.dtype.type(other))


def _routes(docs: DataFrame, width: int, num: int, den: int, bits: int, sent) -> DataFrame:
    """(key, salt, f1, n) of the shingles that route a set; salt -1: not salted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("powers")
        frequent, ranks, hot, salts = sent.value
        seen: set[int] = set()      # copies inside the task
        for batch in batches:
            for _, data, ends in batches_of(batch, size=SLICE):
                keys, names = [], []
                for one in shingle_sets(data, ends, width):
                    n = len(one)
                    f1 = _digest(one)[0] if n else 0
                    if not n or f1 in seen:
                        continue
                    seen.add(f1)
                    p = n - -(-num * n // den) + 1
                    rank = _at(frequent, ranks, (one >> U(64 - bits)).astype(np.uint32), 0)
                    keys.append(one[np.argsort(rank, kind="stable")[:p]] if rank.any() else one[:p])
                    names.append((f1, p, n))
                if not keys:
                    continue
                key = np.concatenate(keys)
                times = [x[1] for x in names]
                f1 = np.repeat(np.array([x[0] for x in names], np.int64), times)
                size = np.repeat(np.array([x[2] for x in names], np.int32), times)
                of = _at(hot, salts, (key >> U(64 - bits)).astype(np.uint32), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.where(of > 1, f1 % of, -1).astype(np.int32)), pa.array(f1), pa.array(size)],
                    ["key", "salt", "f1", "n"])

    return docs.select("text").mapInArrow(run, "key long, salt int, f1 long, n int")


def _candidates(routes: DataFrame, salted: bool, num: int, den: int) -> DataFrame:
    """Edges (a, b) whose components hold every pair that can link.

    A shingle that routes few sets gives their pairs. Of a pair's common shingles
    those up to the smaller last routed one are routed by both, so the overlap is
    at most the number of common routed shingles plus ``ceil(t n) - 1``; pairs
    below what a link needs go. A shingle that routes many sets gives a star.
    """
    routes = routes.repartition("key", "salt").dropDuplicates(["key", "salt", "f1", "n"])
    pooled = Window.partitionBy("key", "salt")
    routes = routes.withColumns({
        "of": F.count(F.lit(1)).over(pooled), "top": F.min("f1").over(pooled),
        "later": F.collect_list(F.struct("f1", "n")).over(pooled.orderBy("f1", "n").rowsBetween(1, FEW - 1))})
    routes = stored(routes.where("of > 1 or salt >= 0").withColumn("many", (F.col("of") > FEW) | (F.col("salt") >= 0))
                    .withColumn("later", F.when(~F.col("many"), F.col("later"))), "routes")
    many = routes.where("many")
    star = many.where("f1 <> top").select(F.col("f1").alias("a"), F.col("top").alias("b"))
    if salted:
        heads = many.where("salt >= 0").groupBy("key", "salt").agg(F.min("f1").alias("f1"))
        across = heads.groupBy("key").agg(F.min("f1").alias("top"))
        star = star.unionByName(heads.join(across, "key").where("f1 <> top").select(F.col("f1").alias("a"), F.col("top").alias("b")))
    hidden = many.groupBy("f1").agg(F.count(F.lit(1)).alias("h"))
    pairs = (routes.where("not many").select(F.col("f1").alias("a"), F.col("n").alias("na"), F.explode("later").alias("x"))
             .select("a", "na", F.col("x.f1").alias("b"), F.col("x.n").alias("nb"))
             .where((F.col("a") != F.col("b")) & (num * F.greatest("na", "nb") <= den * F.least("na", "nb")))
             .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("common")))
    pairs = (pairs.join(hidden.select(F.col("f1").alias("a"), F.col("h").alias("ha")), "a", "left")
             .join(hidden.select(F.col("f1").alias("b"), F.col("h").alias("hb")), "b", "left"))
    common = F.col("common") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
    beyond = F.ceil(F.greatest("na", "nb") * num / den) - 1
    near = pairs.where((common + beyond) * (num + den) >= num * (F.col("na") + F.col("nb")))
    return star.distinct().unionByName(near.select("a", "b"))


class CountTree:
    """Points of group counts, packed into leaves by size and then by their
    largest-spread coordinates; a leaf keeps its coordinate maxima."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets], np.int64)
        # random points differ enough for the bound only with groups in proportion to the sets
        groups = min(GROUPS[1], max(GROUPS[0], 1 << (int(self.size.max()) // 8).bit_length()))
        self.points = np.stack([np.bincount((s & U(groups - 1)).astype(np.int64), minlength=groups) for s in sets]).astype(np.int32)
        order = np.arange(len(sets))
        spread = np.argsort(-self.points.var(0), kind="stable")[:2]
        order = order[np.lexsort((self.points[:, spread[1]], self.points[:, spread[0]], self.size.astype(float).round(-2), ))]
        self.leaf = np.empty(len(sets), np.int64)
        self.leaf[order] = np.arange(len(sets)) // LEAF
        self.members = [order[i:i + LEAF] for i in range(0, len(sets), LEAF)]
        self.high = np.stack([self.points[m].max(0) for m in self.members])
        self.least = np.array([self.size[m].min() for m in self.members])

    def near(self, i: int, num: int, den: int) -> np.ndarray:
        """Sets whose overlap bound with set i reaches what a link needs."""
        q, n = self.points[i], self.size[i]
        bound = np.minimum(self.high, q).sum(1) * (num + den)
        leaves = np.flatnonzero(bound >= num * (n + self.least))
        if not len(leaves):
            return leaves
        at = np.concatenate([self.members[x] for x in leaves])
        bound = np.minimum(self.points[at], q).sum(1) * (num + den)
        keep = bound >= num * (n + self.size[at])
        return at[keep][np.argsort(-bound[keep], kind="stable")]


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both * den >= num * (len(a) + len(b) - both)


def join_block(sets: list[np.ndarray], label: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect, with equal starting labels taken as connected."""
    out: list[tuple[int, int]] = []
    tree, label = CountTree(sets), label.copy()
    for i in range(len(sets)):
        near = tree.near(i, num, den)
        near = near[label[near] != label[i]]
        while len(near):
            j = int(near[0])
            if linked(sets[i], sets[j], num, den):
                out.append((i, j))
                label[label == label[j]] = label[i]
                near = near[label[near] != label[i]]
            else:
                near = near[1:]
    return out


def _join_groups(rows: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) among rows (grp, rep, label, text) of equal grp, which are
    sorted into tasks by grp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("powers")
        group, reps, labels, sets = None, [], [], []

        def done() -> list[tuple[int, int]]:
            if len(sets) < 2:
                return []
            _, label = np.unique(np.array(labels), return_inverse=True)
            return [(reps[i], reps[j]) for i, j in join_block(sets, label, num, den)]

        for batch in batches:
            found: list[tuple[int, int]] = []
            for part, data, ends in batches_of(batch, size=SLICE):
                for g, rep, label, one in zip(part.column("grp").to_pylist(), part.column("rep").to_pylist(),
                                              part.column("label").to_pylist(), shingle_sets(data, ends, width)):
                    if g != group:
                        found += done()
                        group, reps, labels, sets = g, [], [], []
                    reps.append(rep)
                    labels.append(label)
                    sets.append(one)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        found = done()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.repartition("grp").sortWithinPartitions("grp", "rep").mapInArrow(run, "a long, b long")


NO_ID = 1 << 62         # from here on, numbers of rows without an id


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_id): per row its set's size, the
    smallest id its links reach, and the smallest id with an equal set. A row
    without an id counts under 2^62 plus a hash of its text, so a group of such rows
    alone has the smallest of these numbers as its class. Ids lie below 2^62."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.lit(NO_ID) + F.xxhash64(text).bitwiseAND(NO_ID - 1)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), own).alias("doc_id"), text.alias("text"))
    bits = bits_for(rows)
    profile = stored(_profile(rows, width, bits), "profile")
    texts = profile.where("bucket is null").select("doc_id", "n", "f1", "f2")

    frequent, counts = _sketch(profile, bits)
    hot = counts > SALT
    salts = 1 + counts[hot] // SALT
    sent = docs.sparkSession.sparkContext.broadcast((frequent, np.ceil(np.log2(counts)).astype(np.int8), frequent[hot], salts))
    sets = stored(texts.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")), "sets")

    clusters = connected_components(_candidates(_routes(rows, width, num, den, bits, sent), len(salts) > 0, num, den))
    members = stored(sets.join(clusters, sets.f1 == clusters.node).select(
        "rep", "n", F.col("component").alias("cluster"),
        F.floor(F.log(F.col("n") * 1.0) / F.lit(math.log(den / num) * (1 + 1e-9))).cast("int").alias("class")), "members")
    sized = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("of"))
    members = members.join(sized, "cluster")

    small = members.where(F.col("of") <= block).select(
        F.struct(F.col("cluster"), F.lit(0).alias("x"), F.lit(0).alias("y")).alias("g"), "rep", F.col("rep").alias("label"))
    large = stored(members.where(F.col("of") > block), "large")
    any_large = bool(large.take(1))
    plan = small
    if any_large:
        counted = large.groupBy("cluster", "class").agg(F.count(F.lit(1)).alias("in_class"))
        cut = large.join(counted, ["cluster", "class"]).withColumn(
            "x", F.col("class") * 1_000_000 + F.pmod(F.xxhash64("rep"), F.ceil(F.col("in_class") / block)).cast("int"))
        large = stored(cut, "blocks")
        blocks = large.groupBy("cluster", "x").agg(F.count(F.lit(1)).alias("k"))
        picked = large.groupBy("cluster").agg(*[F.min_by("rep", F.xxhash64("rep", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)])
        picked = picked.select("cluster", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("rep"))
        home = large.select("cluster", "x", "rep").unionByName(blocks.join(picked, "cluster").select("cluster", "x", "rep")).distinct()
        plan = small.unionByName(home.select(F.struct("cluster", "x", F.lit(0).alias("y")).alias("g"), "rep", F.col("rep").alias("label")))
    edges = stored(_join_groups(_with_text(rows, plan), width, num, den), "links")

    if any_large:
        first = connected_components(edges)
        named = large.join(first, large.rep == first.node, "left").withColumn("label", F.coalesce("component", "rep"))
        named = stored(named.select("cluster", "class", "rep", "label", "x"), "named")
        top = (named.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("k"))
               .groupBy("cluster").agg(F.max_by("label", F.struct("k", "label")).alias("main")))
        named = named.join(top, "cluster").withColumn("rest", F.col("label") != F.col("main"))
        rest = named.where("rest")
        n_rest = rest.groupBy("cluster", "class").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
        rest = rest.join(n_rest, ["cluster", "class"]).withColumn(
            "y", F.col("class") * 1_000_000 + F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts").cast("long")).cast("int"))
        rest = stored(rest.select("cluster", "class", "rep", "label", "y"), "rest")
        queries = rest.groupBy("cluster", "class", "y").agg(F.count(F.lit(1)).alias("k")).drop("k")
        near = queries.withColumn("class", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
        # each part of the rest meets every block of the sizes it can link with: itself, and the others' rows
        met = (large.select("cluster", "class", "rep", "x").join(named.select("rep", "label"), "rep")
               .join(near, ["cluster", "class"]).select("cluster", "x", "y", "rep", "label"))
        own = (rest.select("cluster", "y", "rep", "label")
               .join(met.groupBy("cluster", "x", "y").agg(F.count(F.lit(1)).alias("k")).drop("k"), ["cluster", "y"])
               .select("cluster", "x", "y", "rep", "label"))
        plan = met.unionByName(own).distinct().select(F.struct("cluster", "x", "y").alias("g"), "rep", "label")
        edges = edges.unionByName(stored(_join_groups(_with_text(rows, plan), width, num, den), "links-2"))
    parts = connected_components(edges)
    rep = sets.join(parts, sets.rep == parts.node, "left").select("n", "f1", "f2", F.col("rep").alias("set_id"), F.coalesce("component", "rep").alias("c"))
    return (texts.join(rep, ["n", "f1", "f2"], "left")
            .select(F.when(F.col("doc_id") < NO_ID, F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"),
                    F.coalesce("set_id", "doc_id").alias("set_id")))


def _with_text(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The planned sets with their texts. Texts are shuffled at every size of the
    plan, so that cost grows evenly."""
    return plan.join(rows.hint("merge"), plan.rep == rows.doc_id).select(F.xxhash64("g").alias("grp"), "rep", "label", "text")
