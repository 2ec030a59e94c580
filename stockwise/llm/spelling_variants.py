"""Spelling variants: words one edit apart, by k-d trees over letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by at most
two in L1: a replacement takes one letter and adds another, an insertion adds one.
So the words near a word lie, in the space of letter counts, in a small box around
it, and its length pairs with its own length and with the next shorter one only.

1. *Words.* Runs of letters are cut, lower-cased and counted by Spark.
2. *Cells.* For each length the upper levels of a k-d tree are fitted on at most
   ``SAMPLE_WORDS`` words (a bound on the fit alone: the splits place every word).
   Each word lives in one cell, and asks in the cells of its length and of the next
   shorter one that a range search by its box reaches.
3. *Search.* Cells are dealt to tasks in blocks of at most about ``BLOCK_WORDS``
   words and ``BLOCK_ASKS`` askers. A block's words form a k-d tree with tight
   boxes; askers go down together, each box prunes those too far off, and at the
   leaves the letter order of the pairs left is verified.
4. *Forms.* A word's form is the most frequent near word, if it is ``RATIO`` times
   as frequent; roots follow forms by pointer doubling, as each step multiplies
   the count by ``RATIO`` at least.

A pair is found once from each side. Words with the same letters (anagrams) share a
cell and are compared block by block; nothing is capped.

Defined results: null and empty texts have no words; a null id counts as an empty
string in the hash; repeated rows count again; an empty table gives no rows; other
columns are ignored. Words may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.llm.common import LOWER, UPPER, stored

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT, RATIO, TYPO_EVERY = 6, 5, 5, 199
GROUPS = 32                     # a to z, and six groups of the other letters
SAMPLE_WORDS, CELL_WORDS = 100_000, 1_000
BLOCK_WORDS, BLOCK_ASKS, LEAF = 2_000, 20_000, 24
FAR = 1 << 30


def group_table() -> np.ndarray:
    """Group of each letter: letters share groups only beyond a to z, which makes
    counts closer, never farther apart."""
    table = np.arange(256) % 6 + 26
    table[97:123] = np.arange(26)
    return table


GROUP = group_table()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int = TYPO_EVERY,
                min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of ``min_letters`` letters or more that stand ``min_count``
    times or more. Runs whose hash with the id ``typo_every`` divides lose a letter,
    as planted typing errors."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), 0)).alias("run"))
    runs = runs.where(F.length("run") >= min_letters).withColumn("run", F.translate("run", UPPER, LOWER))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.pmod("h", F.lit(typo_every)) == 0, less).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def letter_rows(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """Letter counts by group of each row."""
    n, length = rows.shape
    at = np.repeat(np.arange(n) * GROUPS, length) + GROUP[rows].ravel()
    return np.bincount(at, minlength=n * GROUPS).reshape(n, GROUPS).astype(np.int32)


class Tree:
    """A k-d tree: nodes with their boxes, split where counts vary most. With
    ``tight`` a box bounds the node's own points, else it is the cell that the
    splits cut out of space, so that it holds any other point sent there."""

    def __init__(self, points: np.ndarray, leaf: int, tight: bool) -> None:
        self.split: list[tuple[int, int, int, int] | None] = []      # group, threshold, left, right
        self.low, self.high, self.members = [], [], []
        low, high = np.full(GROUPS, -FAR), np.full(GROUPS, FAR)
        self._grow(points, np.arange(len(points)), leaf, tight, low, high)

    def _grow(self, points: np.ndarray, of: np.ndarray, leaf: int, tight: bool, low: np.ndarray, high: np.ndarray) -> int:
        me = len(self.split)
        mine = points[of]
        if tight:
            low, high = mine.min(axis=0), mine.max(axis=0)
        self.split.append(None)
        self.low.append(low)
        self.high.append(high)
        self.members.append(of)
        if len(of) <= leaf:
            return me
        group = int(mine.var(axis=0).argmax())
        values = mine[:, group]
        if values.min() == values.max():
            return me
        at = int(np.median(values))
        at = at if at < values.max() else at - 1
        below, left_high, right_low = values <= at, high.copy(), low.copy()
        left_high[group], right_low[group] = at, at + 1
        self.members[me] = None
        left = self._grow(points, of[below], leaf, tight, low, left_high)
        right = self._grow(points, of[~below], leaf, tight, right_low, high)
        self.split[me] = (group, at, left, right)
        return me

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls into."""
        out, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while todo:
            node, of = todo.pop()
            if self.split[node] is None:
                out[of] = node
                continue
            group, at, left, right = self.split[node]
            below = points[of, group] <= at
            todo += [(left, of[below]), (right, of[~below])]
        return out

    def search(self, points: np.ndarray, lost: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the points that one edit may take into them: a point may have
        one letter that the box lacks, and may lack ``lost`` letters of the box."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, of = todo.pop()
            mine = points[of]
            over = np.maximum(mine - self.high[node], 0).sum(axis=1)
            under = np.maximum(self.low[node] - mine, 0).sum(axis=1)
            of = of[(over <= 1) & (under <= lost)]
            if not len(of):
                continue
            if self.split[node] is None:
                yield node, of
            else:
                todo += [(self.split[node][2], of), (self.split[node][3], of)]


def cell_trees(words: DataFrame) -> dict[int, Tree]:
    """Upper tree levels by word length, from a bounded sample of the words."""
    sample = words.orderBy(F.xxhash64("word")).limit(SAMPLE_WORDS).select("word").toArrow().column("word").to_pylist()
    share = max(1.0, words.count() / max(1, len(sample)))
    by_length: dict[int, list[bytes]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w.encode("latin-1"))
    leaf = max(1, int(CELL_WORDS / share))
    return {k: Tree(letter_counts(letter_rows(v)), leaf, tight=False) for k, v in by_length.items() if len(v) > leaf}


ROUTES = "length int, cell int, asks boolean, word string, n long"


def _routes(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Each word at home in its cell, and as asker in all cells it must search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            sizes = np.array([len(w) for w in rows])
            for size in np.unique(sizes):
                of = np.flatnonzero(sizes == size)
                points = letter_counts(letter_rows([rows[i] for i in of]))
                none = np.zeros(len(of), np.int64)
                home = trees[size].home(points) if size in trees else none
                out = [(size, home, False, of)]
                for length, lost in ((size, 1), (size - 1, 0)):
                    if length in trees:
                        out += [(length, np.full(len(at), cell), True, of[at]) for cell, at in trees[length].search(points, lost)]
                    else:
                        out.append((length, none, True, of))
                for length, cell, asks, at in out:
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), length, np.int32)), pa.array(cell.astype(np.int32)), pa.array(np.full(len(at), asks)),
                         batch.column("word").take(at), batch.column("n").take(at)], ["length", "cell", "asks", "word", "n"])

    return words.select("word", "n").mapInArrow(run, ROUTES)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether a row of ``longer`` is that of ``shorter`` with one letter more:
    letters equal from the front and, moved by one, from the back cover it."""
    size = shorter.shape[1]
    front = np.logical_and.accumulate(longer[:, :size] == shorter, axis=1).sum(axis=1)
    back = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return front + back >= size


PAIRS = "word string, near string, near_n long"


def pairs_of_block(block: pa.Table) -> pa.Table:
    """Near pairs between a block's words and its askers."""
    asks = np.asarray(block.column("asks"))
    names = [w.encode("latin-1") for w in block.column("word").to_pylist()]
    sizes = np.array([len(w) for w in names], np.int64)
    lives = np.flatnonzero(~asks)
    asked, answer = [], []
    if len(lives):
        size = sizes[lives[0]]
        here = letter_rows([names[i] for i in lives])
        counts = letter_counts(here)
        tree = Tree(counts, LEAF, tight=True)
        for longer, lost in ((0, 1), (1, 0)):
            who = np.flatnonzero(asks & (sizes == size + longer))
            if not len(who):
                continue
            rows = letter_rows([names[i] for i in who])
            points = letter_counts(rows)
            for node, of in tree.search(points, lost):
                members = tree.members[node]
                for a in range(0, len(of), 1 + (1 << 17) // len(members)):
                    part = of[a:a + 1 + (1 << 17) // len(members)]
                    left, right = np.repeat(part, len(members)), np.tile(members, len(part))
                    apart = points[left] - counts[right]
                    near = np.flatnonzero((np.abs(apart).sum(axis=1) <= 1 + lost) & (apart.max(axis=1) <= 1) & (apart.min(axis=1) >= -lost))
                    left, right = left[near], right[near]
                    near = one_inserted(rows[left], here[right]) if longer else one_replaced(rows[left], here[right])
                    asker, answered = who[left[near]], lives[right[near]]
                    asked += [asker, answered] if longer else [asker]
                    answer += [answered, asker] if longer else [answered]
    to = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
    word, n = block.column("word"), block.column("n")
    return pa.table({"word": word.take(to(asked)), "near": word.take(to(answer)), "near_n": n.take(to(answer))})


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all words of ``words`` (word, n) one edit apart, both
    ways."""
    routes = stored(_routes(words, cell_trees(words)), "routes")
    cells = routes.groupBy("length", "cell").agg(
        F.ceil(F.count(F.when(~F.col("asks"), 1)) / BLOCK_WORDS).cast("int").alias("blocks"),
        F.ceil(F.count(F.when(F.col("asks"), 1)) / BLOCK_ASKS).cast("int").alias("turns")).where("blocks > 0 and turns > 0")
    salt = F.xxhash64("word")
    dealt = routes.join(cells, ["length", "cell"]).select(
        *routes.columns,
        F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(salt, "blocks").cast("int")))).alias("block"), "turns")
    dealt = dealt.select(
        *routes.columns, "block",
        F.explode(F.when(F.col("asks"), F.array(F.pmod(salt, "turns").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("turns") - 1))).alias("turn"))
    return dealt.groupBy("length", "cell", "block", "turn").applyInArrow(pairs_of_block, PAIRS)


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of ``words`` (word, n)."""
    words = stored(words.select("word", "n"), "words")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    step = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:     # each round doubles the forms followed
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "roots")
        step = after.select("word", "root")
        if not after.where("more").take(1):
            break
    return found.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
