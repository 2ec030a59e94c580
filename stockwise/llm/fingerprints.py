"""Document fingerprints by a homomorphic multiset hash.

A text is cut into pieces (paragraphs, cut on at sentence ends and at 200
characters). Each piece is hashed into a wide vector; the fingerprint is the sum
of the vectors modulo 2^60, lane by lane. So it does not depend on the order of
pieces, and pieces are inserted or deleted by adding or subtracting their
vectors. Lanes: the number of pieces; four sums of 60-bit hashes, for equality;
sixty sums of hash bits, each of two 30-bit counters, for likeness. A piece has
two characters or more, but for the last, so no text that fits a row (2^31 bytes)
fills a counter; fingerprints may be combined up to 2^30 - 1 pieces in all.

A counter's sign sum (``2 c - n``) is a linear sketch: the mean square of the
differences of two fingerprints' sign sums estimates the size of the multiset
difference, and likeness is ``1 - difference / (size + size)``, from 0 to 1.

Defined results: null text is empty; the empty text has no pieces and the zero
vector; equal vectors have likeness 1; an empty one against another 0; rows of
equal id are ordered by text; null ids come last; a lone document is its own next;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwise.llm.common import let

PIECE = r"[^\n.!?]{1,200}[\n.!?]*|[\n.!?]+"
MASK = (1 << 60) - 1
LANE = 30                                            # bits of a counter
COUNTERS = 60 // LANE                                # counters in a sum
SPREAD = sum(1 << (LANE * k) for k in range(COUNTERS))
HEX = 60 // 4                                        # hexadecimal digits of a lane
SUMS, SKETCHES = 4, 2
LANES = 1 + SUMS + SKETCHES * LANE
BUCKET_ROWS, MAX_BUCKETS = 1000, 10_000              # rows of a range of ids; most ranges (larger ones spill)
STEP = 100                                           # range ends searched at once


def vector(text: Column) -> Column:
    """The fingerprint's lanes, array<long>."""
    zero = F.lit(0).cast("long")
    mask, spread = F.lit(MASK), F.lit(SPREAD)

    def total(values: Column, of) -> Column:
        return F.aggregate(values, zero, lambda a, h: (a + of(h)).bitwiseAND(mask))

    def lanes(h: Column) -> Column:
        out = [F.size(h[0]).cast("long")]
        out += [total(h[k], lambda x: x.bitwiseAND(mask)) for k in range(SUMS)]
        out += [total(h[SUMS + k], lambda x, s=s: F.shiftrightunsigned(x, s).bitwiseAND(spread)) for k in range(SKETCHES) for s in range(LANE)]
        return F.array(*out)

    def seeded(k: int):
        return lambda x: F.xxhash64(x, F.lit(k))

    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))
    return let(pieces, lambda p: let(
        F.array(*[F.transform(p, seeded(k)) for k in range(SUMS + SKETCHES)]), lanes))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the multiset sum (``sign`` 1) or difference (-1)."""
    return F.zip_with(a, b, lambda x, y: (x + y if sign > 0 else x + F.lit(MASK + 1) - y).bitwiseAND(F.lit(MASK)))


def as_text(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), HEX, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1."""
    def signs(v: Column) -> Column:
        packed = F.slice(v, 2 + SUMS, SKETCHES * LANE)
        count = lambda x, k: F.shiftright(x, LANE * k).bitwiseAND(F.lit((1 << LANE) - 1))
        return F.flatten(F.transform(packed, lambda x: F.array(*[(2 * count(x, k) - v[0]).cast("double") for k in range(COUNTERS)])))

    def square(v: Column) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)

    def of(p: Column) -> Column:
        apart = square(F.zip_with(p["a"], p["b"], lambda x, y: x - y))
        size = square(p["a"]) + square(p["b"])
        return F.when(p["same"], F.lit(1.0)).when(size == 0, F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - apart / size)))

    return let(F.struct(a.alias("x"), b.alias("y")), lambda v: let(
        F.struct(signs(v["x"]).alias("a"), signs(v["y"]).alias("b"), (v["x"] == v["y"]).alias("same")), of))


def _ends(rows: DataFrame) -> tuple[list[int], int]:
    """Ends of ranges of about ``BUCKET_ROWS`` rows each, from Spark's mergeable
    quantiles of all ids, and the number of ranges for rows without an id."""
    n, nulls = rows.agg(F.count("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    ranges = max(1, min(n // BUCKET_ROWS, MAX_BUCKETS))
    ends = []
    if ranges > 1:
        at = F.array(*[F.lit(k / ranges) for k in range(1, ranges)])
        ends = rows.agg(F.percentile_approx("doc_id", at, 10 * MAX_BUCKETS)).first()[0]
    return sorted(ends), max(1, min(nulls // BUCKET_ROWS, MAX_BUCKETS))


def _range(ends: list[int], nulls: int) -> Column:
    """Number of a row's range, growing with (doc_id, h). An id that is the end
    of several ranges holds as many ranges' rows: its rows are cut by ``h``."""
    def share(h: Column, parts: Column) -> Column:
        place = (h.cast("double") / float(1 << 64) + 0.5) * parts
        return F.greatest(F.lit(0), F.least(F.floor(place).cast("int"), parts - 1))

    x, h = F.col("doc_id"), F.col("h")
    bounds = F.from_json(F.lit(str(ends)), "array<bigint>")
    tops = F.from_json(F.lit(str(ends[::STEP])), "array<bigint>")

    def below(strictly: bool) -> Column:
        # whole steps that end below the id, then the step in which it falls
        less = (lambda e: e < x) if strictly else (lambda e: e <= x)
        return let(F.greatest(F.size(F.filter(tops, less)) - 1, F.lit(0)) * STEP,
                   lambda skip: skip + F.size(F.filter(F.slice(bounds, skip + 1, F.lit(STEP)), less)))

    known = let(F.struct(below(True).alias("lo"), below(False).alias("hi")),
                lambda p: F.when(p["hi"] > p["lo"], p["lo"] + share(h, p["hi"] - p["lo"])).otherwise(p["lo"]))
    return F.when(x.isNotNull(), known).otherwise(share(h, F.lit(nulls)) - nulls)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, v, next_text, next_v): each document with its fingerprint
    and the next one in descending id, the first after the last; equal ids by the
    hash of their texts, descending, rows without an id last.

    Ids fall into ranges of about equal numbers of rows, however they are spread;
    rows of one frequent id, or of none, are spread over ranges by their texts'
    hash. Inside a range a window finds the next row; a range's last row takes the
    first of the next range, from a table of at most ``2 * MAX_BUCKETS`` rows. The
    texts are shuffled once. Rows equal in id and text share a range, which spills.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ends, nulls = _ends(rows)
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("bucket", _range(ends, nulls))
    first = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("first"))
    down = Window.orderBy(F.col("bucket").desc())     # over one row a range
    first = first.withColumn("before", F.coalesce(F.lag("bucket").over(down), F.last("bucket").over(
        down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    heads = (rows.join(F.broadcast(first.select(F.col("bucket").alias("b"), "before", "first")),
                       (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h")))
             .select(F.col("before").alias("of"), F.col("text").alias("head")).dropDuplicates(["of"]))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("h").desc(), "text")
    placed = rows.repartition("bucket").withColumn("v", vector(F.col("text")))
    placed = placed.withColumn("next", F.lead(F.struct("text", "v")).over(order))
    heads = heads.withColumn("head", F.struct(F.col("head").alias("text"), vector(F.col("head")).alias("v")))
    found = placed.join(heads, (F.col("bucket") == F.col("of")) & F.col("next").isNull(), "left")
    found = found.withColumn("next", F.coalesce("next", "head"))
    return found.select("doc_id", "text", "v", F.col("next.text").alias("next_text"), F.col("next.v").alias("next_v"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (the last third replaced
    by the start of the next document's), with both likenesses."""
    rows = with_next(docs, id_col, text_col)
    n = F.length("text")
    part = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - part), F.substring("next_text", F.lit(1), part))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "v", "next_v", edited.alias("edited"))
    rows = rows.withColumn("e", vector(F.col("edited")))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("v")).alias("fingerprint"),
                       as_text(F.col("e")).alias("edited_fingerprint"), likeness(F.col("v"), F.col("e")).alias("near_edited"),
                       likeness(F.col("v"), F.col("next_v")).alias("near_next"))
