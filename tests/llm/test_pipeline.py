"""The pipeline's stages on the small tables and on odd rows."""

import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from stockwise.llm import ngram_join, packing, suffix_dedup
from stockwise.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert docs.where("length > 0").count() > 0


def test_stages_on_odd_rows(spark, odd):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).collect()
        assert stage(spark, odd.limit(0), SF).collect() == []


def test_one_copy_outlives_null_and_repeated_ids(spark):
    def said(k):
        return " ".join(f"{k}word{i}" for i in range(100))

    rows = [(1, said("a")), (None, said("a")), (None, said("b")), (None, said("b")), (2, said("c")), (2, said("d")), (2, said("c")),
            (None, said("e")), (None, said("f")), (9, said("g")), (4, said("g")), (None, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, n_chars long")
    kept = stored(corpus_pipeline.near_duplicate_groups(spark, docs, SF), "once")
    left = corpus_pipeline.repeated_passages(spark, kept, SF).collect()
    want = [(1, "a"), (None, "b"), (2, "c"), (2, "d"), (None, "e"), (None, "f"), (4, "g")]
    key = lambda r: (r[1], r[0] or 0)
    assert sorted([(r.doc_id, r.text) for r in left if r.text], key=key) == sorted([(i, said(k)) for i, k in want], key=key)


def test_tasks_free_what_other_operators_keep_in_a_worker():
    """A worker that packed goes on with the n-gram join: no vocabulary stays, and
    of the hash tables only those that the join uses, for short texts short ones."""
    class Rows:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    suffix_dedup.powers(10, narrow=True)
    suffix_dedup.let_go("powers")
    assert not packing._ENCODERS and "up31" in suffix_dedup.powers(10)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c d e f", None])], ["doc_id", "text"])
    suffix_dedup.let_go()
    packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(len(x) for x in ngram_join._profile(Rows(), 5)(iter([batch]))) > 2
    assert not packing._ENCODERS
    held = suffix_dedup._POWERS
    assert "up31" not in held and len(held["up"]) <= suffix_dedup.LEAST_POWERS + 1


def test_shingles_do_not_depend_on_the_slices():
    texts = pa.array([" ".join(f"w{i * k % 997}" for i in range(3000)) for k in range(1, 8)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    whole = [s for _, data, ends in suffix_dedup.batches_of(batch) for s in ngram_join.shingle_sets(data, ends, 5)]
    parts = list(suffix_dedup.batches_of(batch, size=1000))
    cut = [s for _, data, ends in parts for s in ngram_join.shingle_sets(data, ends, 5)]
    assert len(parts) == 7 and all((a == b).all() for a, b in zip(whole, cut, strict=True))
