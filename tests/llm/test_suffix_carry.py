"""Removal of repeats with columns carried along."""

import random

from stockwise.llm.suffix_dedup import remove_repeats


def test_carried_columns_do_not_shuffle_the_texts_again(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefghij klmnop", k=n))
    shared = word(900)
    rows = [(i, word(300 + 40 * i) + (shared if i % 2 else shared[50:700]) + word(500), f"l{i % 3}") for i in range(12)]
    docs = spark.createDataFrame(rows + rows[:1] + [(None, shared, None), (99, None, "l0")], "doc_id long, text string, lang string")
    kept = remove_repeats(docs, 400, carry=["lang"])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.rest.lang) for r in kept.collect()]
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(k1" in line and "REPARTITION_BY_COL" in line]
    assert len(dealt) == 2 and sum("ReusedExchange" in line for line in dealt) == 1
    key = lambda r: tuple((c is None, c or 0) for c in r[:3])
    plain = remove_repeats(docs.drop("lang"), 400).select("doc_id", "n_bytes", "n_removed").collect()
    assert sorted((r[:3] for r in got), key=key) == sorted(map(tuple, plain), key=key)
    lang = {r[0]: r[2] for r in rows} | {None: None, 99: "l0"}
    assert all(r[3] == lang[r[0]] for r in got) and sum(r[2] > 0 for r in got) == 14
