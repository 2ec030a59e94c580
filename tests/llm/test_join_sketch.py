"""The count sketch of the n-gram join grows with the text, and only its frequent buckets leave the tasks."""

import numpy as np
from pyspark.sql import functions as F

from stockwise.llm import ngram_join as N

PASSAGE = " ".join(f"common{i}" for i in range(40))


def _docs(spark, n):
    """Texts of their own words around one passage that all share; every tenth has a near copy."""
    own = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(n)]
    texts = [f"{t} {PASSAGE}" for t in own] + [f"{own[i]} extra {PASSAGE}" for i in range(0, n, 10)] + ["", "one two", own[3]]
    return spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), texts


def test_the_sketch_has_buckets_for_the_text(spark, monkeypatch):
    monkeypatch.setattr(N, "BUCKET_BITS", (10, 28))
    docs, texts = _docs(spark, 50)
    few = N.bits_for(docs)
    many = N.bits_for(docs.crossJoin(spark.range(64)))
    assert few == 10 and many == int(np.ceil(np.log2(64 * sum(map(len, texts)) / N.WORD_BYTES / N.BUCKET_LOAD))) > 12
    assert N.bits_for(docs.limit(0)) == 10
    assert N.bits_for(spark.createDataFrame([(1, "x" * 9)], "doc_id long, text string")) == 10


def test_counts_of_frequent_buckets_are_exact(spark, monkeypatch):
    monkeypatch.setattr(N, "COUNTED", 500)       # several sendings a task
    docs, texts = _docs(spark, 60)
    for bits in (18, 27):
        profile = N._profile(docs.repartition(3), 5, bits).persist()
        data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        sets = [N.shingle_sets(d, np.array([0, len(d)]), 5)[0] for d in data]
        want, hits = np.unique(np.concatenate(sets) >> np.uint64(64 - bits), return_counts=True)
        frequent, counts = N._sketch(profile, bits)
        assert dict(zip(frequent.tolist(), counts.tolist())) == {b: h for b, h in zip(want.tolist(), hits.tolist()) if h > 8}
        assert len(frequent) >= 30 and frequent.tolist() == sorted(frequent.tolist())
        sizes = {r.doc_id: r.n for r in profile.where("bucket is null").collect()}
        assert sizes == {i: len(s) for i, s in enumerate(sets)}
        profile.unpersist()


def test_buckets_are_looked_up(spark):
    found = N._at(np.array([3, 9], np.uint32), np.array([5, 7], np.int8), np.array([0, 3, 4, 9, 11], np.uint32), 0)
    assert found.tolist() == [0, 5, 0, 7, 0]
    assert N._at(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.array([1], np.uint32), 1).tolist() == [1]


def test_a_passage_of_all_ties_no_documents_at_a_fuller_size(spark, monkeypatch):
    """With buckets in proportion a shared passage routes nothing; the classes are right at any number of bits."""
    docs, texts = _docs(spark, 60)
    classes = {}
    for bits in ((8, 8), (23, 28)):
        monkeypatch.setattr(N, "BUCKET_BITS", bits)
        classes[bits] = {r.doc_id: r.component_id for r in N.near_duplicates(docs).collect()}
    assert classes[8, 8] == classes[23, 28]
    of = classes[23, 28]
    assert all(of[60 + k] == 10 * k for k in range(6)) and sum(of[i] == i for i in range(60)) == 60
    used = []
    monkeypatch.setattr(N, "_candidates", lambda routes, *a, f=N._candidates: (used.append(routes.groupBy("key").agg(
        F.count_distinct("f1").alias("n")).agg(F.max("n")).first()[0]), f(routes, *a))[1])
    N.near_duplicates(docs).collect()
    assert used[0] < 60
