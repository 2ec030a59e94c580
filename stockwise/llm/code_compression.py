"""Product codes of vectors by Lloyd rounds over resident members.

Vectors become integers ``floor(scale * x)`` and are cut into equal consecutive
parts; every part position has a codebook of ``entries`` entries.

* *Residence.* Parts live in rows partitioned by (position, entry, salt): their
  entry's owners. Salts deal each entry's members in round robin, so the entry of a
  third of all parts has as many owners as its size asks for.
* *Update.* Each owner sums its resident members; a few sums an entry meet at the
  driver, which replaces the entry by ``floor(sum / count)``.
* *Migration.* Members compare with the new codebooks where they are. Only those
  whose entry changed enter the next shuffle, to the owners of their new entry, and
  land in a table of their own; the others are not moved or written again. A member
  of an earlier table is still resident if every codebook since its landing gives
  its entry, which its owner sees by itself, so departures need no bookkeeping.

All sums and distances are exact integers. Tables are written in the shared folder,
so lost executors only repeat tasks. Codebooks (``entries`` times the dimension
numbers) are the only thing that passes the driver.

Defined results: vectors that are null, or hold null or non-finite components, are
dropped; the dimension is that of the first kept vector by (id, components); vectors
of another dimension, and all vectors where it is not a multiple of the number of
parts, keep a row with null code and error; null ids come last; rows of equal id all
count; fewer rows than entries give as many entries as rows; an
empty table gives no rows. Components of 2^15 or more, whose errors may not fit a
long, raise an error. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
OWNER_PARTS = 256               # about as many members of an entry has an owner
LARGEST = 1 << 27               # integers of this size have errors that fit a long
Codebooks = list[np.ndarray]    # by position: (entries, width) integers


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def integers(vectors: pa.ListArray, dim: int, scale: int) -> np.ndarray:
    """Rows of ``floor(scale * x)`` of vectors of ``dim`` components."""
    flat = np.asarray(vectors.flatten()).astype(np.float64).reshape(-1, dim)
    flat = np.floor(flat * scale)
    if flat.size and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST // scale} or more are too large for exact errors")
    return flat.astype(np.int64)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry, the lower of equally near ones, and its distance."""
    best = ((parts - book[0]) ** 2).sum(axis=1)
    entry = np.zeros(len(parts), np.int64)
    for e in range(1, len(book)):
        d = ((parts - book[e]) ** 2).sum(axis=1)
        closer = d < best
        entry[closer], best[closer] = e, d[closer]
    return entry, best


MEMBERS = "position int, entry int, salt int, n long, part array<long>"


def _rows(position: np.ndarray, entry: np.ndarray, salt: np.ndarray, n: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1]), pa.array(parts.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(salt.astype(np.int32)),
                                       pa.array(n.astype(np.int64)), flat], ["position", "entry", "salt", "n", "part"])


def _summed(position: np.ndarray, entry: np.ndarray, parts: np.ndarray, entries: int) -> pa.RecordBatch:
    """One row an entry: the sum and number of its parts, with salt -1."""
    key, where = np.unique(position * entries + entry, return_inverse=True)
    sums = np.zeros((len(key), parts.shape[1]), np.int64)
    np.add.at(sums, where, parts)
    return _rows(key // entries, key % entries, np.full(len(key), -1), np.bincount(where, minlength=len(key)), sums)


def _homes(vectors: DataFrame, books: Codebooks, dim: int, scale: int, salts: int) -> DataFrame:
    """Every part at the owner of its first entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = 0
        for batch in batches:
            whole = integers(batch.column("v"), dim, scale)
            for p, book in enumerate(books):
                parts = whole[:, p * book.shape[1]:(p + 1) * book.shape[1]]
                entry, _ = nearest(parts, book)
                yield _rows(np.full(len(parts), p), entry, (np.arange(len(parts)) + dealt) % salts, np.ones(len(parts)), parts)
            dealt += len(whole)

    return vectors.mapInArrow(run, MEMBERS).repartition("position", "entry", "salt")


def _migration(landed: DataFrame, since: list[Codebooks], salts: int) -> DataFrame:
    """Of the members in ``landed`` that all codebooks of ``since`` but the last
    left where they are: those that the last one moves, one row each, and the sums
    of those that stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, dealt = max(len(b) for b in since[-1]), 0
        for batch in batches:
            position, entry = (np.asarray(batch.column(c)).astype(np.int64) for c in ("position", "entry"))
            parts = np.asarray(batch.column("part").flatten()).reshape(len(batch), -1)
            now, here = entry.copy(), np.ones(len(batch), bool)
            for k, books in enumerate(since):
                for p in np.unique(position[here]):
                    of = np.flatnonzero(here & (position == p))
                    now[of], _ = nearest(parts[of], books[p])
                if k < len(since) - 1:
                    here &= now == entry
            stay, go = here & (now == entry), np.flatnonzero(here & (now != entry))
            yield _summed(position[stay], entry[stay], parts[stay], entries)
            yield _rows(position[go], now[go], (np.arange(len(go)) + dealt) % salts, np.ones(len(go)), parts[go])
            dealt += len(go)

    return landed.where("salt >= 0").mapInArrow(run, MEMBERS)


def _updated(books: Codebooks, members: DataFrame, width: int) -> Codebooks:
    """Entries replaced by the floor of the mean of their members; those without
    members stay."""
    sums = members.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("part")[i]).alias(f"s{i}") for i in range(width)])
    out = [b.copy() for b in books]
    for p, e, n, *s in sums.collect():       # one row an entry: bounded by the codebooks' size
        out[p][e] = [x // n for x in s]
    return out


def train(vectors: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
          id_col: str = "vec_id") -> Codebooks:
    """Codebooks of the vectors in column ``v``, all of ``dim`` components."""
    width = dim // parts
    lead = vectors.orderBy(F.col(id_col).asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    first = integers(lead.column("v").combine_chunks(), dim, scale)
    books = [first[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    salts = vectors.count() // OWNER_PARTS + 1
    tables = [(0, stored(_homes(vectors, books, dim, scale, salts), "members-0"))]
    history = [books]
    history.append(_updated(books, tables[0][1], width))
    for r in range(1, rounds):
        moves = None
        for landed, table in tables:
            part = _migration(table, history[landed + 1:r + 1], salts)
            moves = part if moves is None else moves.unionByName(part)
        table = stored(moves.repartition("position", "entry", "salt"), f"members-{r}")
        tables.append((r, table))
        history.append(_updated(history[r], table, width))
        if all((a == b).all() for a, b in zip(history[-1], history[-2])):
            break       # no entry changed: the rounds left would change nothing
    return history[-1]


def encode(vectors: DataFrame, books: Codebooks, dim: int, scale: int, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``code``, two hex digits a part, and ``error``."""
    digits = np.array([f"{i:02x}" for i in range(256)])
    fields = [vectors.schema[c] for c in keep]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch.column("v"), dim, scale)
            code, error = np.full(len(whole), "", f"<U{2 * len(books)}"), np.zeros(len(whole), np.int64)
            for p, book in enumerate(books):
                entry, distance = nearest(whole[:, p * book.shape[1]:(p + 1) * book.shape[1]], book)
                code = np.char.add(code, digits[entry])
                error += distance
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(code.tolist(), pa.string()), pa.array(error)], [*keep, "code", "error"])

    return vectors.select(*keep, "v").mapInArrow(run, f"{types}, code string, error long")


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error) of every usable vector, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("codes hold two hex digits a part")
    rows = embeddings.where(usable(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    lead = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v")).limit(1).collect()
    dim = lead[0][0] if lead else 0
    if not dim or dim % parts:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), []
    whole, other = rows.where(F.size("v") == dim), rows.where(F.size("v") != dim)
    books = train(whole, dim, parts, entries, rounds, scale)
    coded = encode(whole, books, dim, scale, ["vec_id", "label"])
    return coded.unionByName(other.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: errors summed over equal labels, null labels together."""
    coded = stored(coded, "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of the codes, errors and codebooks: one assignment a round."""
    assign = """a{r} AS MATERIALIZED (SELECT id, p, min(v) AS v, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT q.id, q.p, q.v, b.e, list_sum(list_transform(list_zip(q.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM q JOIN b{r} AS b USING (p)) GROUP BY id, p)"""
    update = """b{n} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{r} AS b LEFT JOIN (
  SELECT p, e, list(f ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS f
    FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e) AS m USING (p, e))"""
    steps = ",\n".join(s for r in range(rounds) for s in (assign.format(r=r), update.format(r=r, n=r + 1)))
    return f"""
WITH k AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
q AS MATERIALIZED (SELECT id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM (SELECT *, unnest(range({parts})) AS p FROM k)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY id) - 1 AS e, v AS c FROM q WHERE id IN (SELECT id FROM k ORDER BY id LIMIT {entries})),
{steps},
{assign.format(r=rounds)},
c AS (SELECT id, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d) AS error FROM a{rounds} GROUP BY id),
s AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT id AS vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s.h AS codebooks_sha256
FROM c JOIN k USING (id), s"""
