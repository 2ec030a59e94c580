"""License scan: phrases, and an exact set-similarity join with license notices.

Base labels come from phrases whose words stand consecutively. The method joins
text blocks with notice templates. Blocks are paragraphs (lines with words, without
a wordless line between them), so wrapped and commented notices stay whole. A block
has a template's label when one of its windows does: a window is one and a half
times the template's words long, begins with a word of the template, contains at
least ``threshold`` of the template's distinct words, all words that tell it from
other licenses (``NEEDS``) and none that change its meaning (``BARS``). Words are
ordered by corpus frequency, rarest first; only words of templates can match, so
the order covers the templates' vocabulary. A block and a template that qualify
share a word among the template's first ``|T| - need + 1`` and the block's first
``|B| - need + 1`` words (prefix filter; the first shared word stands in both, and
each pair is verified there once), ``|B| >= need`` (length filter), and from the
places of the shared word enough words are left on both sides (positional filter).
Survivors are verified by intersection, then window by window. The filters are
necessary conditions, so no qualifying block is lost.

Defined results: null and empty texts have no words, no labels and score 0;
``score`` is the best containment of any template in any qualifying window, 1 where
a phrase stands; repeated rows are judged each; an empty table gives no rows; other
columns are ignored. No row holds more than one text; templates are a fixed, small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import LOWER, UPPER, let, stored

# What stands between words; A-Z count as letters here, since words are lower-cased afterwards.
SEP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Lines without a word stand between paragraphs.
PARAGRAPH = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"

# Sentences of public license notices.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "this work is licensed under a creative commons attribution non commercial 4 0 international license": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "released under the gpl license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "released under the bsd license": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

# Words that a window must hold for any template that has them: they name the license, or its sentence.
NEEDS = {"mit", "apache", "gnu", "gpl", "bsd", "mozilla", "cc", "nc", "noncommercial", "non", "creative", "attribution", "hereby",
         "merchantability", "kind", "compliance", "applicable", "redistribute", "redistribution", "unencumbered", "license", "3"}

# Words that, in a window, make another license of a label's templates that lack them.
BARS = {"cc-by": {"nc", "noncommercial", "non", "sa", "sharealike", "nd", "noderivatives", "noderivs"},
        "cc-by-nc": {"sa", "sharealike", "nd", "noderivatives", "noderivs"},
        "gpl": {"lesser", "affero", "library"}, "gpl-3": {"lesser", "affero", "library"}}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SEP, -1), lambda w: w != "")


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _places(words: Column, n: Column, phrase: str) -> Column:
    parts = phrase.split()

    def stands(i: Column) -> Column:
        out = words[i] == F.lit(parts[0])
        for k, w in enumerate(parts[1:], 1):
            out = out & (words[i + k] == F.lit(w))
        return out

    return F.when(n >= len(parts), F.filter(F.sequence(F.lit(0), n - len(parts)), stands)).otherwise(F.array().cast("array<int>"))


def _phrase_scan(text: Column, phrases: dict[str, str]) -> Column:
    """Struct (label, places) per phrase, for texts in which one may stand."""
    may = None
    for phrase in phrases:
        hit = text.rlike("(?i)" + SEP.join(phrase.split()))
        may = hit if may is None else may | hit
    none = F.array().cast("array<struct<label:string,at:array<int>>>")
    scan = let(_words(_lower(text)), lambda w: F.array(*[
        F.struct(F.lit(label).alias("label"), _places(w, F.size(w), phrase).alias("at")) for phrase, label in phrases.items()]))
    return F.when(may, F.filter(scan, lambda x: F.size(x["at"]) > 0)).otherwise(none)


def word_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Words of ``vocabulary`` by the number of texts that hold them, rarest
    first, ties by word. At most ``len(vocabulary)`` counts reach the driver."""
    known = F.array(*[F.lit(w) for w in sorted(vocabulary)])
    held = docs.select(F.explode(F.array_intersect(known, F.transform(
        _words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), lambda w: F.when(w.rlike("[A-Z]"), _lower(w)).otherwise(w)))).alias("w"))
    counts = {r.w: r.n for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def rules(templates: dict[str, str], num: int, den: int, order: dict[str, int] | None = None) -> list[tuple]:
    """Per template: its text, distinct words (by ``order``), words needed of
    them, window length, words a window must hold and words it must not."""
    out = []
    for t in templates:
        words = sorted(set(t.split()), key=order.get if order else None)
        out.append((t, words, -(-num * len(words) // den), len(t.split()) * 3 // 2 + 1,
                    [w for w in words if w in NEEDS], sorted(BARS.get(templates[t], set()) - set(words))))
    return out


def _words_of(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _best_window() -> Column:
    """Most template words in one window of ``marks`` that holds all ``needs``
    and none of ``bars``. A window has at most ``span`` marks from its first on."""
    def held(first: Column, i: Column) -> Column:
        near = F.transform(F.filter(F.slice("marks", i + 1, F.col("span")), lambda y: y["at"] < first["at"] + F.col("span")), lambda y: y["w"])
        fits = let(near, lambda ws: F.when(
            (F.size(F.array_intersect(ws, "needs")) == F.size("needs")) & ~F.arrays_overlap(ws, "bars"),
            F.size(F.array_intersect(ws, "t_words"))).otherwise(0))
        return F.when(F.array_contains("t_words", first["w"]), fits).otherwise(0)

    return F.array_max(F.transform("marks", held))


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, num: int = 80, den: int = 100,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score."""
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.split()}.union(*[BARS.get(label, set()) for label in templates.values()]))
    order = word_order(docs, vocabulary, text_col)
    ruled = rules(templates, num, den, order)
    index = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(word).alias("word"), F.lit(at).alias("t_at"), F.lit(templates[t]).alias("label"), _words_of(words).alias("t_words"),
                 F.lit(need).alias("need"), F.lit(span).alias("span"), _words_of(needs).alias("needs"), _words_of(bars).alias("bars"))
        for t, words, need, span, needs, bars in ruled
        for at, word in enumerate(words[:len(words) - need + 1])])))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ranked = _words_of(sorted(order, key=order.get))
    # a paragraph without any of these words lacks a needed word of each template: it is not cut into words
    first = sorted({w for _, words, need, _, needs, _ in ruled for w in (needs[:1] or words[:len(words) - need + 1])})
    gate = "(?i)(?<![a-z0-9\\x{80}-\\x{10FFFF}])(?:" + "|".join(first) + ")(?![a-z0-9\\x{80}-\\x{10FFFF}])"
    blocks = F.transform(F.filter(F.split(text, PARAGRAPH, -1), lambda x: x.rlike(gate)), lambda x: F.filter(
        F.transform(_words(_lower(x)), lambda w, i: F.struct(i.alias("at"), w.alias("w"))), lambda x: x["w"].isin(vocabulary)))
    least = min(need for _, _, need, _, _, _ in ruled)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), F.size(_words(F.col("text"))).cast("long").alias("n_words"),
                       _phrase_scan(F.col("text"), phrases).alias("found"),
                       F.array_distinct(F.filter(blocks, lambda b: F.size(b) >= least)).alias("blocks"))
    rows = stored(rows, "license-rows")

    b = (rows.where(F.size("blocks") > 0).select("doc_id", "h", F.explode("blocks").alias("marks"))
         .withColumn("b", F.array_intersect(ranked, "marks.w"))
         .select("doc_id", "h", "marks", "b", F.posexplode("b").alias("b_at", "word")))
    both = F.array_intersect("b", "t_words")
    joined = (b.join(F.broadcast(index), "word")
              .where((F.size("b") >= F.col("need")) & (F.col("b_at") <= F.size("b") - F.col("need"))
                     & (1 + F.least(F.size("b") - F.col("b_at") - 1, F.size("t_words") - F.col("t_at") - 1) >= F.col("need")))
              .where((F.size(both) >= F.col("need")) & (both[0] == F.col("word")))
              .withColumn("both", _best_window()).where("both >= need"))
    method = joined.groupBy("doc_id", "h").agg(F.collect_set("label").alias("more"), F.max(F.col("both") / F.size("t_words")).alias("best"))

    base = F.transform("found", lambda x: x["label"])
    at = F.flatten(F.transform("found", lambda x: x["at"]))
    joined_rows = rows.alias("r").join(method.alias("m"), (F.col("r.doc_id").eqNullSafe(F.col("m.doc_id"))) & (F.col("r.h") == F.col("m.h")), "left")
    return joined_rows.select(
        "r.doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"), F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.size(at) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def oracle(phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, num: int = 80, den: int = 100) -> str:
    """DuckDB SQL that compares every window of every paragraph with every template."""
    phrase_rows = ", ".join(f"({p.split()!r}, '{label}')" for p, label in phrases.items())
    template_rows = ", ".join(f"({words!r}, '{templates[t]}', {need}, {span}, {needs!r}::VARCHAR[], {bars!r}::VARCHAR[])"
                              for t, words, need, span, needs, bars in rules(templates, num, den))
    cut = r"list_filter(regexp_split_to_array(translate({}, '" + UPPER + "', '" + LOWER + r"'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
WITH w AS (SELECT doc_id, {cut.format("coalesce(text, '')")} AS ws, regexp_split_to_array(coalesce(text, ''), '{PARAGRAPH}') AS ls FROM documents),
p(parts, label) AS (VALUES {phrase_rows}), t(parts, label, need, span, needs, bars) AS (VALUES {template_rows}),
f AS (SELECT doc_id, label, list_filter(range(0, len(ws) - len(parts) + 1), lambda i: ws[i + 1:i + len(parts)] = parts) AS pl FROM w, p),
b AS (SELECT doc_id, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE len(pl) > 0), '') AS base_labels,
             sum(len(pl)) AS n_base, min(list_min(pl)) AS first_word, max(list_max(pl)) AS last_word FROM f GROUP BY 1),
l AS (SELECT doc_id, {cut.format("x")} AS ws FROM (SELECT doc_id, unnest(ls) AS x FROM w)),
v AS (SELECT doc_id, label, need, len(parts) AS size, list_max(list_transform(range(0, len(ws)), lambda i:
        CASE WHEN list_contains(parts, ws[i + 1]) AND list_has_all(ws[i + 1:i + span], needs) AND NOT list_has_any(ws[i + 1:i + span], bars)
             THEN len(list_intersect(ws[i + 1:i + span], parts)) ELSE 0 END)) AS k
      FROM l, t WHERE len(list_intersect(ws, parts)) >= need AND list_has_all(ws, needs)),
m AS (SELECT doc_id, label, max(k / size) AS c FROM v WHERE k >= need GROUP BY 1, 2),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
      (SELECT doc_id, label FROM m UNION SELECT doc_id, label FROM f WHERE len(pl) > 0) GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, n_base::BIGINT AS n_base, first_word, last_word, base_labels, coalesce(a.labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce((SELECT max(c) FROM m WHERE m.doc_id = w.doc_id), 0.0) END::DOUBLE AS score
FROM w JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)"""
