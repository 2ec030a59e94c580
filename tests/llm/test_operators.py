"""Each operator against a brute-force version, and on odd inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import duckdb
import pytest

from stockwise.llm import chat_format, fingerprints, license_scan, ngram_join, packing, pii, quality_rules, queries, sentencepiece_codec, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"
BPE, SP = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def repeats(rows, length):
    data = [t.encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (k, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((k, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("salt", [1, 1000])
def test_suffix_dedup_equals_brute_force(spark, odd, salt, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SALT_SPANS", salt)
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = suffix_dedup.remove_repeats(docs, 400).drop("kept_text").collect()
    assert Counter(map(tuple, got)) == repeats(texts(docs), 400)
    assert suffix_dedup.remove_repeats(odd.limit(0), carry=["lang"]).collect() == []


def components(rows):
    sets = {}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t))
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k: (len(s), top(k)) for k, s in sets.items()}


@pytest.mark.parametrize(("few", "block"), [(32, 2000), (2, 3)])
def test_ngram_join_equals_brute_force(spark, odd, few, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", few)
    docs = odd.where("doc_id is not null").select((odd.doc_id + 100_000).alias("doc_id"), "text").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, block=block).collect()}
    assert got == components(texts(docs))


def test_ngram_join_odd_tables(odd):
    rows = ngram_join.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (8, 9)} == {8}
    assert [r.component_id for r in rows if r.doc_id in (4, 5, 6)] and all(r.component_id == r.doc_id for r in rows if r.doc_id in (4, 5, 6))
    assert ngram_join.near_duplicates(odd.limit(0)).collect() == []


def test_packing_ids_and_places(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    tok.encode_special_tokens = True
    strange = ["  a  b", "x\n  b", "it's <|endoftext|> a\n\n b ", "a   b", "x\n\nT\n T  \n\nT ", "é,ça.\né\nÉ ×a÷ b", "a　 b c", "你好, x 😀b 12ab"]
    docs = odd.select("doc_id", "text").where("doc_id is null or doc_id <> 2").unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(strange)], "doc_id long, text string"))
    want = {k: tok.encode(t, add_special_tokens=False).ids + [1] for k, t in texts(docs)}
    got = defaultdict(list)
    places = defaultdict(list)
    for r in packing.pack(docs, BPE, 256, with_ids=True).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        got[r.doc_id].append((r.start, r.ids))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: [x for _, ids in sorted(v) for x in ids] for k, v in got.items()} == want
    padding = 0
    for v in places.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        padding += 0 if at & (at - 1) == 0 else 256 - at
        assert at <= 256
    assert padding == 0
    assert packing.pack(odd.limit(0), BPE).collect() == []


def test_quality_measures_and_rules(spark, odd, labels):
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    for r in quality_rules.judged(docs, []).collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        inside = {i + k for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert r.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w)) and r.kept == (not r.base_failed)
    assert quality_rules.quality_rules(odd, labels).count() == odd.count()
    assert quality_rules.quality_rules(odd.limit(0), labels.limit(0)).collect() == []


def test_quality_rules_learn_a_planted_rule(spark):
    rows = [(i, "word " * 60 + ("#### $$$ " * 20 if i % 5 == 0 else " ".join(f"u{i}v{j}" for j in range(60)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 != 0)) for i, _ in rows], "doc_id long, quality int")
    rules = quality_rules.learn(quality_rules.labelled_cases(docs, marks, 1000))
    judged = {r.doc_id: r.rule for r in quality_rules.judged(docs, rules).collect()}
    assert rules and all((judged[i] > 0) == (i % 5 == 0) for i, _ in rows)


def test_license_scan_odd(odd):
    rows = license_scan.scan_licenses(odd).collect()
    assert len(rows) == odd.count()
    r = next(r for r in rows if r.doc_id == 10)
    assert (r.n_base, r.base_labels, r.labels, r.score) == (2, "cc-by-nc,mit", "cc-by-nc,mit", 1.0) and r.first_word == 6
    assert all((r.n_base, r.labels, r.score) == (0, "", 0.0) for r in rows if r.doc_id in (4, 5, 6))
    assert license_scan.scan_licenses(odd.limit(0)).collect() == []


LICENSE_CASES = [
    ("Released under the BSD License.", "bsd"), ("The tool is released under the GPL license", "gpl"), ("Data licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"), ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc"), ("Licensed under CC BY-SA 4.0.", ""),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ""),
    ("the report was released to staff under review while the driving license office was closed", ""),
    ("It is released under the terms of the MIT License, also for commercial use.", "mit"),
    ("/*\n * Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and\n * associated documentation files\n */", "mit"),
    ("# Unless required by applicable law or agreed to in writing,\n# software distributed under the License is distributed on an\n# \"AS IS\" BASIS", "apache-2"),
    ("permission is hereby granted free of charge\n\nto any person obtaining a copy of this software and associated documentation files", ""),
    ("This is free software under the GNU Lesser General Public License version 3", ""),
    ("word " * 5000 + "Redistribution and use in source and binary forms, with or without modification, are permitted " + "word " * 5000, "bsd"),
]


def test_license_windows(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(LICENSE_CASES)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs).collect()}
    assert got == {i: label for i, (_, label) in enumerate(LICENSE_CASES)}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert {i: labels for i, labels in con.execute(f"SELECT doc_id, labels FROM ({license_scan.oracle()})").fetchall()} == got


def test_chat_layouts_round_trip(spark):
    rows = [(1, 0, "user", "a </turn> &lt; <turn role=\"x\">"), (1, 1, "assistant", "\\n &amp;"), (2, 0, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"),
            (3, None, "we\"ird", "x" * 50_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat_format.format_chats(chat_format.records(table).withColumn("extra", chat_format.F.lit(1)))
    got = {r.conv_id: r for r in done.withColumn("t", chat_format.read_back(chat_format.F.col("formatted"))).withColumn(
        "loss", chat_format.loss_text(chat_format.F.col("formatted"), chat_format.F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in got[1].t] == [(r, t) for _, _, r, t in rows[:2]] and got[1].layout == "prompt_response" and got[1].loss == rows[1][3]
    assert [tuple(t) for t in got[2].t] == [("", ""), ("assistant", "b"), ("assistant", "b")] and got[2].loss == "bb"
    assert [tuple(t) for t in got[3].t] == [("we\"ird", "x" * 50_000)] and got[3].loss == ""
    assert chat_format.digests(chat_format.format_chats(chat_format.records(table.limit(0)))).collect() == []
    other = spark.createDataFrame([("do", "in", "out", None), ("do", None, "out", None), (None, None, None, "?")], "instruction string, input string, output string, odd string")
    found = chat_format.canonical(other).collect()
    assert [r.layout for r in found] == ["instruction_input", "instruction", None]
    assert tuple(found[0].turns[0]) == ("user", "do\n\nin") and found[2].turns is None


def test_fingerprints(spark, odd):
    docs = odd.select("doc_id", "text", "v")
    rows = fingerprints.fingerprint_documents(docs).collect()
    order = sorted(((-k if k is not None else 1, t) for k, t in texts(docs)), key=lambda x: (x[0] == 1, x))
    want = Counter()
    for i, (k, t) in enumerate(order):
        n, follow = len(t), order[(i + 1) % len(order)][1]
        want[(None if k == 1 else -k, n, hashlib.sha256((t[:n - n // 3] + follow[:n // 3]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert len({r.fingerprint for r in rows}) == len({t for _, t in texts(docs)})
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    v = fingerprints.vector
    lit = fingerprints.F.lit
    r = spark.range(1).select(v(lit("a.\nb.\n")).alias("ab"), v(lit("b.\na.\n")).alias("ba"), fingerprints.combined(v(lit("a.\n")), v(lit("b.\n"))).alias("sum"),
                              fingerprints.combined(v(lit("a.\nb.\n")), v(lit("b.\n")), -1).alias("less"), v(lit("a.\n")).alias("a")).first()
    assert r.ab == r.ba == r.sum and r.less == r.a
    assert fingerprints.fingerprint_documents(odd.limit(0)).collect() == []


def test_pii_surrogates(odd):
    said = ("Call +1 (017) 555-7713 or 017-555-7713, the.72@Mail7.example.com, 10.158.249.239; 4539 1488 0343 6467 "
            "\"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" Mr. John Smith met Mrs. Anna Smith; г-жа Анна Иванова")
    made, kinds = pii.replaced(said, b"k", {})
    assert made == pii.replaced(said, b"k", {})[0] != pii.replaced(said, b"other", {})[0]
    a, b = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3}-\d{3}-\d{4})", made).group(1, 4)
    assert b.startswith(a) and ", 10." in made and pii.luhn(re.search(r"(?:\d{4} ){3}\d{4}", made).group().replace(" ", "")) == pii.luhn("4539148803436467")
    smiths = re.findall(r"(?:Mr|Mrs)\. \w+ (\w+)", made)
    assert smiths[0] == smiths[1] != "Smith" and re.search("г-жа [А-Яа-я]+[ая] [А-Яа-я]+", made)
    assert not any(said[x:y] in made for _, _, ps in pii.entities(said) for x, y, k, _ in ps if k not in ("ip",))
    assert len({tuple(pii.permuted([i // 100, i // 10 % 10, i % 10], [10] * 3, b"k", "x")) for i in range(1000)}) == 1000
    rows = pii.replace_pii(odd, "k").collect()
    before = {(r.doc_id, r.text) for r in odd.collect()}
    assert len(rows) == odd.count() and {(r.doc_id, r.text) for r in rows if not r.n_entities} <= before
    assert next(r for r in rows if r.doc_id == 4).text is None
    assert pii.replace_pii(odd.limit(0), "k").collect() == []


def test_pii_collisions_are_drawn_again(spark):
    # two-character addresses: surrogates of some are others
    docs = spark.createDataFrame([(i, f"write {chr(97 + i % 26)}{i // 26}@a.bc now") for i in range(200)], "doc_id long, text string")
    rows = pii.replace_pii(docs, "k").collect()
    found = [re.search(r"\S+@\S+", r.text).group() for r in rows]
    assert len(set(found)) == 200 and not set(found) & {re.search(r"\S+@\S+", r.text).group() for r in docs.collect()}


def test_toxicity_learns_and_scores_all(spark, odd, labels):
    def text(i):
        return " ".join(f"q{(i * 7 + j) % 300}" for j in range(40)) + (" horrible" if i % 8 == 0 else "")

    docs = spark.createDataFrame([(i, text(i)) for i in range(1200)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(1200)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, marks).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 8 == 0) for r in held) >= 0.98 * len(held)
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(odd.limit(0), labels.limit(0)).collect() == []


def best_segmentation(c, word):
    """Dictionary search over all pieces of a word (bytes)."""
    score = {c.pieces[i]: (s, i) for i, s in zip(c.ids, c.scores)}
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        got = (best[end - 1][0] + sentencepiece_codec.BYTE_SCORE, best[end - 1][1] + [int(c.bytes_of[word[end - 1]])])
        for start in range(end - 1, -1, -1):
            s = score.get(word[start:end])
            if s and best[start][0] + s[0] >= got[0]:
                got = (best[start][0] + s[0], best[start][1] + [int(s[1])])
        best[end] = got
    return best[-1][1]


def test_sentencepiece_viterbi_and_round_trip(odd):
    c = sentencepiece_codec.Codec(SP)
    words = ["hello", "Straße", "日本語x", "thninering", "\t", "a,b.c", "😀😀"]
    for w in words:
        flat, _ = c.encode(pa.array([w], pa.large_string()))
        assert flat.tolist() == best_segmentation(c, b"\xe2\x96\x81" + w.encode())
    strange = ["", " ", "  a  b ", "▁a ▁", "\n\n", "a\nb", "日本 語"]
    flat, ends = c.encode(pa.array(strange, pa.large_string()))
    assert c.decode(flat, ends).to_pylist() == strange
    coded = sentencepiece_codec.encode(odd, SP)
    back = Counter((r.doc_id, r.text) for r in sentencepiece_codec.decode(coded, SP).collect())
    assert back == Counter(texts(odd))
    assert sentencepiece_codec.encode(odd.limit(0), SP, digest=True).collect() == []


def test_packing_gives_added_tokens_their_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    said = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>b\n", "plain words <|endoftext| >", "after it"]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").coalesce(1)
    got = defaultdict(list)
    for r in packing.pack(docs, BPE, 256, with_ids=True, added=True).collect():
        got[r.doc_id].append((r.start, r.ids))
    want = {k: tok.encode(t, add_special_tokens=False).ids + [1] for k, t in enumerate(said)}
    assert {k: [x for _, ids in sorted(v) for x in ids] for k, v in got.items()} == want and 50256 in want[0]
    # the registered query too
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    rows = queries.op10_cost_balanced_packing(spark, str(tmp_path)).collect()
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()) for r in rows)


def test_fingerprint_counters_hold_long_texts(spark):
    lines = [f"line {i}" for i in range(100_000)]
    said = {"one": lines, "edited": lines[:66_667] + [f"new {i}" for i in range(33_333)], "other": [f"row {i}" for i in range(100_000)],
            "equal": ["same"] * 40_000, "equal_edited": ["same"] * 20_000 + ["else"] * 20_000}
    v = spark.createDataFrame([tuple("\n".join(x) for x in said.values())], list(said)).select(*[fingerprints.vector(fingerprints.F.col(c)).alias(c) for c in said])
    near = lambda a, b: fingerprints.likeness(fingerprints.F.col(a), fingerprints.F.col(b))
    r = v.select(near("one", "edited").alias("edited"), near("one", "other").alias("other"), near("equal", "equal_edited").alias("equal"), "equal").first()
    assert abs(r[0] - 2 / 3) < 0.15 and r[1] < 0.25 and abs(r[2] - 0.5) < 0.35
    packed = r[3][1 + fingerprints.SUMS:]
    assert r[3][0] == 40_000 and all((x >> fingerprints.LANE * k) & ((1 << fingerprints.LANE) - 1) in (0, 1, 39_999, 40_000) for x in packed for k in range(fingerprints.COUNTERS))


def surrogates_of(spark, said, pattern):
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    return [re.search(pattern, r.text).group() for r in pii.replace_pii(docs, "k").orderBy("doc_id").collect()]


def test_pii_names_stay_apart(spark):
    letters = "bcdfghjklm"
    names = [f"{a}{b}{c}{d}y" for a in letters for b in letters for c in letters for d in letters]
    made = surrogates_of(spark, [f"Mr. {x.capitalize()} came" for x in names], r"(?<=Mr\. )\w+")
    assert len({x.lower() for x in made}) == 10_000 and not {x.lower() for x in made} & set(names)


def test_pii_crowded_formats(spark):
    # one-letter addresses: 676 strings, each entity and its surrogate take two
    pairs = [f"{chr(97 + i // 26)}@{chr(97 + i % 26)}.com" for i in range(676)]
    made = surrogates_of(spark, [f"write {x} now" for x in pairs[:330]], r"\S+@\S+")
    assert len(set(made)) == 330 and not set(made) & set(pairs[:330])
    with pytest.raises(ValueError, match="no surrogates left for email"):
        surrogates_of(spark, [f"write {x} now" for x in pairs[:400]], r"\S+@\S+")


@pytest.mark.parametrize("ids", ["far", "hot", "none", "even"])
def test_fingerprint_ranges_hold_any_ids(spark, monkeypatch, ids):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 5)
    monkeypatch.setattr(fingerprints, "STEP", 7)
    of = {"far": lambda i: 10 ** 15 if i == 0 else i, "hot": lambda i: 40 if i % 2 else i, "none": lambda i: None if i % 3 == 0 else i, "even": lambda i: -i}[ids]
    docs = spark.createDataFrame([(of(i), f"text {i}.") for i in range(600)], "doc_id long, text string")
    rows = fingerprints.with_next(docs).collect()
    after = {r.text: r.next_text for r in rows}
    assert len(rows) == 600 == len(after) == len(set(after.values()))
    place, walk = max((r for r in rows if r.doc_id is not None), key=lambda r: r.doc_id).text, []
    known = {r.text: r.doc_id for r in rows}
    for _ in range(600):
        walk.append(known[place])
        place = after[place]
    have = [x for x in walk if x is not None]
    assert have == sorted(have, reverse=True) and walk[len(have):] == [None] * (600 - len(have)) and len(set(after)) == 600
    sizes = docs.withColumn("h", fingerprints.F.xxhash64("text")).groupBy(fingerprints._range(*fingerprints._ends(docs))).count()
    assert max(r["count"] for r in sizes.collect()) <= 25
