"""Quality rules learned as an ordered decision list, applied as Spark conditions.

Features are JVM column expressions over the whole text. Learning is sequential
covering: a rule starts empty and grows by the threshold condition with the best
gain, read from counts by (feature, bin, label) that Spark aggregates; it is then
pruned on held-out rows, and the rows it covers are set aside before the next
rule. Only counts by bin reach the driver, so their size does not depend on the
data. The list becomes one ``CASE WHEN`` expression: first rule that holds rejects.

``max_labelled`` bounds the labelled rows that are used (by hash of their id).

Defined results: null text is empty; an empty text has all measures 0; repeated
rows count each; labels that are null are ignored; without labelled rows, or
without rows of both classes, the list is empty and nothing is rejected by it;
other columns pass through ``judged`` unless they have a measure's name, which
replaces them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import let, stored, unused_name

BLANK = r"[ \t-\r]+"
BINS = 32
MAX_LABELLED = 20_000       # labelled rows that teach
FEATURES = ["n_words", "word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share", "distinct_share"]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. A window is one
    long: the top bits of its hash over the bits of its place. Sorting brings
    equal windows together; neighbours are compared by their words."""
    bits = F.ceil(F.log2(n + F.lit(1.0))).cast("int")

    def of(b: Column) -> Column:
        place = F.call_function("shiftleft", F.lit(1).cast("long"), b) - F.lit(1)
        windows = F.sort_array(F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.call_function("shiftleft", F.call_function("shiftright", F.xxhash64(words[i], words[i + 1], words[i + 2]), b), b)
            .bitwiseOR(i.cast("long"))))

        def pairs(s: Column) -> Column:
            at = lambda k: s[k].bitwiseAND(place).cast("int")
            same = lambda k: ((F.call_function("shiftright", s[k], b) == F.call_function("shiftright", s[k - 1], b))
                              & (F.slice(words, at(k) + 1, 3) == F.slice(words, at(k - 1) + 1, 3)))
            found = F.filter(F.sequence(F.lit(1), n - 3), same)
            return F.flatten(F.transform(found, lambda k: F.array(
                at(k), at(k) + 1, at(k) + 2, at(k - 1), at(k - 1) + 1, at(k - 1) + 2)))

        return F.size(F.array_distinct(let(windows, pairs))).cast("long")

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(bits, of))


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long) and the shares that rules may use."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        without = lambda pattern: F.length(F.regexp_replace(t, F.lit(pattern), F.lit("")))
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
        words = F.filter(F.split(t, BLANK, -1), lambda w: w != "")
        chars = F.length(t)
        return let(
            F.struct(words.alias("w"), lines.alias("l"), chars.alias("c"), without(BLANK).alias("k")),
            lambda v: let(F.struct(
                v["w"].alias("w"), F.size(v["w"]).alias("n"), F.size(v["l"]).alias("l"),
                (F.size(v["l"]) - F.size(F.array_distinct(v["l"]))).alias("d"), v["k"].alias("k"),
                (v["c"] - without("[#*$%&|<>]+")).alias("s"), (v["c"] - without(r"\p{Lu}+")).alias("u"), (v["c"] - without("[!?]+")).alias("m")),
                lambda x: let(_repeat_words(x["w"], x["n"]), lambda rep: F.struct(
                    x["n"].cast("long").alias("n_words"), x["k"].cast("long").alias("word_chars"), x["s"].cast("long").alias("n_symbols"),
                    x["d"].cast("long").alias("n_dup_lines"), rep.alias("n_repeat_words"),
                    _share(x["k"], x["n"]).alias("word_length"), _share(x["s"], x["k"]).alias("symbol_share"),
                    _share(x["u"], x["k"]).alias("upper_share"), _share(x["m"], x["k"]).alias("mark_share"),
                    _share(x["d"], x["l"]).alias("dup_line_share"), _share(rep, x["n"]).alias("repeat_share"),
                    _share(F.size(F.array_distinct(x["w"])), x["n"]).alias("distinct_share")))))

    return let(text, of)


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool             # feature >= cut, else feature < cut
    cut: float

    def column(self, of: Column) -> Column:
        value = of[self.feature].cast("double")
        return value >= F.lit(self.cut) if self.above else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def rule_column(rule: Rule, of: Column) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(of)
    return out


def verdict(rules: list[Rule], of: Column) -> Column:
    """Number of the first rule that holds (from 1), or 0: an ordered CASE WHEN."""
    out = None
    for i, rule in enumerate(rules, 1):
        hit = rule_column(rule, of)
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def labelled_cases(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """Measures and class of labelled documents, about ``max_labelled`` at most.
    The chosen labels are a bounded table, so they are broadcast and no text is
    shuffled."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.col(label_col).cast("int")).alias("label"))
    n = marks.count()
    if n > max_labelled:
        marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * max_labelled / n)))
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(marks), "id")
    return chosen.select("id", (F.col("label") == 0).cast("int").alias("bad"), measures(F.col("text")).alias("m"))


def learn(cases: DataFrame, min_precision: float = 0.95, max_rules: int = 8, max_conditions: int = 3, min_cover: int = 5,
          features: list[str] = FEATURES) -> list[Rule]:
    """Rules for class ``bad`` = 1 from rows (id, bad, m). Two thirds of the rows
    grow a rule, one third prunes it."""
    cases = stored(cases.select("bad", (F.pmod(F.xxhash64("id", F.lit(11)), F.lit(3)) == 0).alias("held"), "m"), "cases")
    cuts_at = [i / BINS for i in range(1, BINS)]
    # cut points follow the rarer class as well, whose values may lie beyond the common quantiles
    found = cases.groupBy("bad").agg(*[F.percentile_approx(F.col(f"m.{f}").cast("double"), cuts_at, 10_000).alias(f) for f in features]).collect()
    if len(found) < 2:
        return []
    cuts = {f: sorted({x for r in found for x in r[f]}) for f in features}
    binned = stored(cases.select("bad", "held", "m", *[
        _bin(F.col(f"m.{f}").cast("double"), cuts[f]).alias(f"bin_{f}") for f in features]), "binned")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"bin_{f}").alias("b")) for f in features])).alias("p")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = binned.where(verdict(rules, F.col("m")) == 0)
        rule: Rule = ()
        best_before = None
        while len(rule) < max_conditions:
            counts = (left.where(~F.col("held") & rule_column(rule, F.col("m"))).select("bad", pairs)
                      .groupBy("p.f", "p.b").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect())
            got = _best_condition(counts, cuts, features, min_cover, best_before)
            if got is None:
                break
            condition, bad, n = got
            rule += (condition,)
            best_before = (bad, n)
            if bad == n:
                break
        if not rule:
            break
        rule = _pruned(left, rule, min_precision)
        if rule is None:
            break
        rules.append(rule)
    return rules


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cut points the value reaches."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value))


def _best_condition(counts: list, cuts: dict, features: list[str], min_cover: int, before: tuple | None) -> tuple | None:
    """FOIL gain over thresholds; None if none improves precision."""
    best = None
    for f in features:
        rows = sorted(((r.b, r.bad, r.n) for r in counts if r.f == f))
        bad_all, n_all = sum(r[1] for r in rows), sum(r[2] for r in rows)
        if not bad_all or bad_all == n_all and before is not None:
            continue
        base = math.log2((bad_all + 1) / (n_all + 2))
        bad, n = 0, 0
        for b, cut in enumerate(cuts[f]):
            bad += sum(r[1] for r in rows if r[0] == b)
            n += sum(r[2] for r in rows if r[0] == b)
            for above, p, k in ((True, bad_all - bad, n_all - n), (False, bad, n)):
                if p < min_cover or k == n_all:
                    continue
                gain = p * (math.log2((p + 1) / (k + 2)) - base)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, Condition(f, above, float(cut)), p, k)
    return best and best[1:]


def _pruned(left: DataFrame, rule: Rule, min_precision: float) -> Rule | None:
    """The prefix of the rule that is best on the pruning rows, if precise on
    both parts."""
    sums = []
    for k in range(1, len(rule) + 1):
        hit = rule_column(rule[:k], F.col("m"))
        for part, on in (("h", F.col("held")), ("g", ~F.col("held"))):
            sums.append(F.sum(F.when(hit & on, F.col("bad")).otherwise(0)).alias(f"{part}p{k}"))
            sums.append(F.sum(F.when(hit & on, 1).otherwise(0)).alias(f"{part}n{k}"))
    r = left.agg(*sums).first()
    good = []
    for k in range(1, len(rule) + 1):
        hp, hn, gp, gn = (r[f"{c}{k}"] or 0 for c in ("hp", "hn", "gp", "gn"))
        if hp + gp and (hp + gp) / (hn + gn) >= min_precision and (not hn or hp / hn >= min_precision - 0.1):
            good.append(((hp - (hn - hp)) / max(hn, 1), hp + gp, -k, rule[:k]))
    return max(good, key=lambda x: x[:3])[3] if good else None


MEASURES = "_measures"


def _base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def judged(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the measures, ``base_failed``, ``rule`` (of
    the list, 0: none) and ``kept``."""
    name = unused_name(docs, MEASURES)
    m = F.col(name)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return docs.withColumn(name, measures(F.col(text_col).cast("string"))).withColumns(
        {c: m[c] for c in names} | {"rule": verdict(rules, m), "base_failed": _base_failed(m), "kept": ~_base_failed(m) & (verdict(rules, m) == 0)}).drop(name)


def kept_documents(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that base rules and list keep. The measures
    are bound to a lambda's variable, as a projected column would be inlined into
    the filter once for every use."""
    return docs.where(let(measures(F.col(text_col).cast("string")), lambda m: ~_base_failed(m) & (verdict(rules, m) == 0)))


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Learn from ``labels.quality`` (0: bad) and judge every document."""
    return judged(docs, learn(labelled_cases(docs, labels, max_labelled)))
