"""Vector codes, spelling variants and repeated phrases against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockwise.llm import code_compression, phrase_automata, queries, spelling_variants

SF = "/root/testdata/sf0.001"


# --- vector codes ---------------------------------------------------------

def lloyd(rows, parts=8, entries=16, rounds=6):
    """Rows (id, label, vector) to Counter of (id, code, error, label_error) and the codebook digest."""
    kept = [(i, b, [int(np.floor(4096 * np.float64(x))) for x in v]) for i, b, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    lead = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * width:(p + 1) * width] for r in lead] for p in range(parts)]

    def best(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, _, v in kept:
                part = v[p * width:(p + 1) * width]
                members[best(part, books[p])[1]].append(part)
            for e, found in members.items():
                books[p][e] = [sum(c) // len(found) for c in zip(*found)]
    out, by_label = [], Counter()
    for i, b, v in kept:
        found = [best(v[p * width:(p + 1) * width], books[p]) for p in range(parts)]
        out.append((i, b, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        by_label[b] += out[-1][3]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, by_label[b]) for i, b, c, e in out), digest


ODD_VECTORS = "vec_id long, label int, embedding array<float>, code string, error int, position int, part array<int>"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, [3]) for r in rows], ODD_VECTORS)


def test_vector_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(code_compression, "OWNER_PARTS", 7)
    rng = np.random.default_rng(3)
    spots = rng.normal(size=(5, 16)) * 0.3
    rows = [(i, int(i % 3) if i % 4 else None, [float(x) for x in (spots[i % 5] + rng.normal(size=16) * 0.1).astype(np.float32)]) for i in range(150)]
    hot = [(200 + i, 1, [0.25] * 16) for i in range(80)]                       # one vector of a third of all rows
    odd = [(3, None, None), (1, 1, [0.1] * 15 + [None]), (2, 1, [float("nan")] * 16), (4, 1, [float("-inf")] * 16),
           (None, 2, [0.5] * 16), (None, 2, [0.5] * 16), (7, 2, [-0.25] * 16), (7, None, [0.125] * 16)]
    want, digest = lloyd(rows + hot + odd)
    coded, books = code_compression.compress(vectors(spark, rows + hot + odd))
    got = code_compression.with_label_errors(coded).select("vec_id", "code", "error", "label_error").collect()
    assert Counter(map(tuple, got)) == want and code_compression.digest(books) == digest


def test_vector_codes_of_few_none_and_ragged_vectors(spark):
    few = [(i, None, [i / 8.0] * 8) for i in range(3)]
    coded, books = code_compression.compress(vectors(spark, few))
    assert sorted(r.error for r in coded.collect()) == [0, 0, 0] and [len(b) for b in books] == [3] * 8
    coded, books = code_compression.compress(vectors(spark, few).limit(0))
    assert code_compression.with_label_errors(coded).collect() == [] and books == []
    coded, _ = code_compression.compress(vectors(spark, few + [(9, 1, [1.0] * 9), (10, 1, [])]))
    assert {r.vec_id: r.code is None for r in coded.collect()} == {0: False, 1: False, 2: False, 9: True, 10: True}
    coded, _ = code_compression.compress(vectors(spark, [(1, 1, [1.0] * 9)]))
    assert [tuple(r) for r in coded.collect()] == [(1, 1, None, None)]
    with pytest.raises(Exception, match="too large"):
        code_compression.compress(vectors(spark, [(1, 1, [1e9] * 8)]))[0].collect()


def test_vector_codes_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    want, digest = lloyd(rows)
    got = queries.QUERIES["op11_vector_codes"](spark, SF).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want and {r.codebooks_sha256 for r in got} == {digest}


# --- spelling variants ----------------------------------------------------

def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def counted(rows):
    words = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def variants(words, ratio=5):
    near, form, out = defaultdict(list), {}, set()
    names = sorted(words)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    for a in names:
        if near[a]:
            top = min(near[a], key=lambda w: (-words[w], w))
            if words[top] >= ratio * words[a]:
                form[a] = top
    for a in names:
        root = a
        while root in form:
            root = form[root]
        out.add((a, form.get(a), root, words[a], len(near[a]), words.get(form.get(a))))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("small", [False, True])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, small):
    """Small cells and blocks, anagrams, repeated letters, long words and chains."""
    if small:
        for name, value in (("CELL_WORDS", 4), ("BLOCK_WORDS", 3), ("BLOCK_ASKS", 4), ("LEAF", 2), ("SAMPLE_WORDS", 60)):
            monkeypatch.setattr(spelling_variants, name, value)
    rng = np.random.default_rng(5)
    words = {}
    for stem in ("letter", "better", "banana", "économie", "ÿÀþorøs", "aaaaaa", "x" * 300, "commerce"):
        words[stem] = 5 ** 5
        for _ in range(25):
            w = stem
            for _ in range(int(rng.integers(1, 3))):
                i, c = int(rng.integers(0, len(w))), "abetréx"[int(rng.integers(0, 7))]
                w = (w[:i] + c + w[i + 1:], w[:i] + w[i + 1:], w[:i] + c + w[i:])[int(rng.integers(0, 3))]
            words[w] = int(5 ** rng.integers(1, 5))
    for _ in range(40):
        words["".join(rng.permutation(list("abcdefg")))] = int(rng.integers(5, 200))      # anagrams
    table = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, near string")
    got = spelling_variants.spelling_variants(table).select(*COLUMNS).collect()
    assert len(got) == len(words) and set(map(tuple, got)) == variants(words)


def test_words_and_variants_of_documents(spark, odd):
    docs = odd.select("doc_id", "text", "n", "h").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "1 AS n", "'h' AS h"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    words = counted(rows)
    assert {r.word: r.n for r in spelling_variants.word_counts(docs).collect()} == words
    got = spelling_variants.spelling_variants(spelling_variants.word_counts(docs)).select(*COLUMNS).collect()
    assert len(got) == len(words) and set(map(tuple, got)) == variants(words)
    assert spelling_variants.spelling_variants(spelling_variants.word_counts(odd.limit(0))).collect() == []


# --- repeated phrases -----------------------------------------------------

def first_windows(rows, length):
    """Counter of (doc_id, n_words, n_removed, n_spans, kept text)."""
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in rows]
    seen, out = set(), []
    for k, ws in split:
        gone = [False] * len(ws)
        for i in range(len(ws) - length + 1):
            w = tuple(ws[i:i + length])
            if w in seen:
                gone[i:i + length] = [True] * length
            seen.add(w)
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((k, len(ws), sum(gone), spans, " ".join(w for w, x in zip(ws, gone) if not x)))
    return Counter(out)


def in_order(spark, docs):
    from pyspark.sql import functions as F
    return [(r.doc_id, r.text or "") for r in docs.withColumn("o", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy(F.col("doc_id").asc_nulls_last(), "o").collect()]


@pytest.mark.parametrize("block", [1 << 21, 5_000])
def test_repeated_windows_equal_brute_force(spark, odd, monkeypatch, block):
    monkeypatch.setattr(phrase_automata, "BLOCK_BYTES", block)
    rng = np.random.default_rng(9)
    passages = [" ".join(f"p{j}q{i}" for i in range(60)) for j in range(6)]
    few = " ".join(["tick tock"] * 40)                         # repeats itself
    mixed = []
    for i in range(60):
        own = " ".join(f"own{i}w{k}" for k in range(int(rng.integers(0, 30))))
        cut = passages[i % 6].split()[int(rng.integers(0, 25)):int(rng.integers(35, 60))]
        mixed.append((500 - i, f"{own}\t{' '.join(cut)}\n{few if i % 7 == 0 else own} {passages[(i * 5) % 6] if i % 3 else ''}"))
    hot = [(1000 + i, passages[0] + " " + passages[1]) for i in range(40)]
    docs = (odd.select("doc_id", "text").unionByName(spark.createDataFrame(mixed + hot, "doc_id long, text string"))
            .unionByName(spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 5000 AS doc_id", "text")))
    got = phrase_automata.remove_repeated_windows(docs, 20).collect()
    assert Counter(map(tuple, got)) == first_windows(in_order(spark, docs), 20)
    assert phrase_automata.remove_repeated_windows(odd.limit(0)).collect() == []


def test_unicode_spaces_stay_inside_words(spark):
    said = " ".join(f"w{i}" for i in range(30))
    rows = [(1, said), (2, said), (3, "\x1c".join("abcdefghijklmnopqrstuvwxyz") + " a"), (4, "\x0b".join("abcdefghijklmnopqrstuvwxyz"))]
    got = phrase_automata.remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == {1: (1, 0), 2: (1, 0), 3: (2, 0), 4: (26, 0)}


def test_repeated_phrase_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {k: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for k, n, gone, _, t in first_windows(in_order(spark, docs), 20)}
    got = queries.QUERIES["op13_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


# --- repairs of earlier operators -------------------------------------------

def test_quality_filter_measures_once(spark, odd):
    from stockwise.llm import quality_rules as Q

    rules = [(Q.Condition("symbol_share", True, 0.5),), (Q.Condition("upper_share", True, 0.9),), (Q.Condition("word_length", False, 1.0),)]
    plan = Q.kept_documents(odd, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("p{Lu}") == 1
    want = {(r.doc_id, r.text) for r in Q.judged(odd.drop("kept"), rules).where("kept").collect()}
    assert {(r.doc_id, r.text) for r in Q.kept_documents(odd, rules).collect()} == want
    clash = odd.select("doc_id", "text", "h").withColumnRenamed("h", "_measures")
    assert "_measures" in Q.judged(clash, rules).columns


def test_near_duplicates_without_ids(spark):
    from stockwise.llm.ngram_join import near_duplicates

    said = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(said)), (None, "z " + " ".join(said)), (None, "alone " * 3 + "here we are"), (None, " ".join(f"v{i}" for i in range(40))),
            (None, " ".join(f"v{i}" for i in range(41))), (5, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.component_id for r in got if r.n_shingles and r.component_id < 100) == [1, 1]
    others = Counter(r.component_id for r in got if r.doc_id is None and r.component_id > 100)
    assert sorted(others.values()) == [1, 2] and sum(r.doc_id is None for r in got) == 4


def test_surrogates_keep_clashing_columns(spark):
    from stockwise.llm import pii

    rows = [(i, f"write to {chr(97 + i % 26)}@example.com or {chr(97 + i // 26)}@example.com", "H", "T") for i in range(330)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string, tw string")
    got = pii.replace_pii(df, "secret").collect()
    assert len(got) == 330 and {(r.h, r.tw) for r in got} == {("H", "T")} and all(r.n_entities == 2 for r in got)
