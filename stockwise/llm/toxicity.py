"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts train a logistic model in numpy on the
risk ``prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))``, which corrects for
the positives inside the unlabelled texts and never falls below zero. Inputs are
hashed words and byte n-grams of the lower-cased text, as presence; id, language,
source and labels are not inputs. Those most different between the two samples
(by the G statistic, from counts that Spark sums) make the model.

The samples are bounded: ``max_positive`` and ``max_unlabelled`` texts, chosen by
hash of their id. The prior is the toxic share of all usable labels. The model
(``2^20`` weights) is of fixed size; every text is scored whole.

Defined results: null and empty texts get the score of a text without evidence;
null labels are ignored, an id with several is toxic if any says so; without
confirmed toxic texts the scores are 0; repeated rows get equal scores; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import stored
from stockwise.llm.suffix_dedup import Prints, batches_of

U = np.uint64
BITS = 20
GRAMS = (5, 8)
MODEL_FEATURES = 4096
SAMPLE_TASKS = 4


def _plain() -> np.ndarray:
    """Letters lower-cased, other ASCII as space, bytes from 128 as they are."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


PLAIN = _plain()


def features(data: np.ndarray, ends: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs; only features that ``wanted`` marks."""
    data = PLAIN[data]
    prints = Prints(data)
    found = []

    def add(lo: np.ndarray, hi: np.ndarray, kind: int) -> None:
        f = (prints.wide(lo, hi) * U(2 * kind + 1) >> U(64 - BITS)).astype(np.int64)
        if wanted is not None:
            hit = wanted[f]
            lo, f = lo[hit], f[hit]
        if len(lo):
            found.append((np.searchsorted(ends, lo, "right") - 1) << BITS | f)

    letter = data != 32
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    after, before = np.append(letter, False), np.append(False, letter)
    add(np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge)), 0)
    for n in GRAMS:
        if len(data) >= n:
            crosses = np.zeros(len(data) + 1, np.int64)
            np.add.at(crosses, np.maximum(ends[1:-1] - n + 1, 0), 1)
            np.add.at(crosses, ends[1:-1], -1)
            lo = np.flatnonzero(np.cumsum(crosses[:len(data) - n + 1]) == 0)
            add(lo, lo + n, n)
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = 400,
          rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam on the non-negative risk. ``rows``/``cols``:
    the ones of the presence matrix; ``positive``: rows of the toxic sample, the
    others are unlabelled."""
    w, b = np.zeros(n_features + 1), np.log(prior / (1 - prior))
    w[-1] = b
    m, v = np.zeros_like(w), np.zeros_like(w)
    n = len(positive)
    in_p, in_u = positive / max(positive.sum(), 1), ~positive / max((~positive).sum(), 1)
    for t in range(1, steps + 1):
        z = np.bincount(rows, weights=w[cols], minlength=n) + w[-1]
        s = sigmoid(z)
        softplus = np.logaddexp(0, z)                       # loss of calling a text toxic when it is not
        negative = (in_u * softplus).sum() - prior * (in_p * softplus).sum()
        of_negative = in_u * s - prior * in_p * s
        if negative >= 0:
            slope = prior * in_p * (s - 1) + of_negative
        else:
            slope = -of_negative                            # back towards zero, as the estimate overfits
        g = np.append(np.bincount(cols, weights=slope[rows], minlength=n_features), slope.sum())
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def _by_hash(id_col: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit(5)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, share)))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_positive: int = 4000, max_unlabelled: int = 12_000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, float] | None:
    """Weights of all hashed features and the intercept. ``usable``: which ids
    (column ``id``) may teach."""
    ids = F.col(id_col).cast("long")
    marks = (labels.select(ids.alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic is not null")
             .where(usable).groupBy("id").agg(F.max("toxic").alias("toxic")))
    n, toxic = marks.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not n or not toxic or toxic == n:
        return None
    texts = docs.select(ids.alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null").where(usable)
    total = texts.select("id").count()
    chosen = marks.where("toxic = 1").where(_by_hash(F.col("id"), max_positive / toxic)).select("id")
    positive = texts.join(F.broadcast(chosen), "id").withColumn("positive", F.lit(True))       # max_positive ids, by hash
    unlabelled = texts.where(_by_hash(F.col("id"), max_unlabelled / total)).withColumn("positive", F.lit(False))
    sample = stored(positive.unionByName(unlabelled).select("positive", "text").repartition(SAMPLE_TASKS), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {p: np.zeros(1 << BITS, np.int64) for p in (True, False)}
        for batch in batches:
            for part, data, ends in batches_of(batch):
                row, f = features(data, ends)
                flag = np.asarray(part.column("positive").to_pylist(), bool)
                for p in held:
                    held[p] += np.bincount(f[flag[row] == p], minlength=1 << BITS)
        some = np.flatnonzero(held[True])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[True][some]), pa.array(held[False][some])], ["f", "p", "u"])

    n_p, n_u = sample.agg(F.sum(F.col("positive").cast("int")), F.sum((~F.col("positive")).cast("int"))).first()
    if not n_p or not n_u:
        return None
    counts = sample.mapInArrow(count, "f long, p long, u long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u")) / F.lit(n_p + n_u)
    gain = 2 * (F.col("p") * F.log(F.col("p") / (n_p * share)) + F.when(F.col("u") > 0, F.col("u") * F.log(F.col("u") / (n_u * share))).otherwise(0.0))
    over = F.col("p") / n_p > F.col("u") / n_u
    top = [r.f for r in counts.where((F.col("p") >= 5) & over).orderBy(gain.desc(), "f").limit(MODEL_FEATURES).collect()]
    if not top:
        return np.zeros(1 << BITS, np.float32), float(np.log(toxic / n / (1 - toxic / n)))
    top = np.sort(np.array(top, np.int64))
    wanted = np.zeros(1 << BITS, bool)
    wanted[top] = True

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, ends in batches_of(batch):
                row, f = features(data, ends, wanted)
                at = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("positive"), pa.ListArray.from_arrays(pa.array(at), pa.array(np.searchsorted(top, f).astype(np.int32)))], ["positive", "f"])

    got = sample.mapInArrow(held, "positive boolean, f array<int>").collect()
    rows = np.repeat(np.arange(len(got)), [len(r.f) for r in got])
    cols = np.array([x for r in got for x in r.f], np.int64)
    w, b = train(rows, cols, np.array([r.positive for r in got], bool), len(top), toxic / n)
    weights = np.zeros(1 << BITS, np.float32)
    weights[top] = w
    return weights, b


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score)."""
    weights, b = model if model is not None else (np.zeros(1 << BITS, np.float32), -30.0)
    sent = docs.sparkSession.sparkContext.broadcast((weights, float(b)))      # 4 MB, fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, b = sent.value
        wanted = weights != 0
        for batch in batches:
            for part, data, ends in batches_of(batch):
                row, f = features(data, ends, wanted)
                z = np.bincount(row, weights=weights[f], minlength=len(part)) + b
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sigmoid(z))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Score all documents; ids whose CRC-32 (as text) is 0 modulo ``folds``
    teach nothing."""
    fold = lambda c: F.crc32(F.col(c).cast("string")) % folds
    out = score(docs, fit(docs, labels, fold("id") != 0))
    return out.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
