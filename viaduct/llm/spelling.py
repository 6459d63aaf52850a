"""Spelling variants: words that differ by one letter, grouped under the much more frequent one.

Words are maximal runs of a-z, A-Z and U+00C0 to U+00FF, with A-Z lower-cased. Two words are near if one inserted,
deleted or replaced letter turns one into the other. A word's form is its near word of the largest count, ties to the
smallest in code-point order, if that count is at least RATIO times its own; its root is where following forms ends.

1. Tasks count the runs of whole texts in tables of at most HELD words and give partial counts, which are summed.
2. Words are compared per pair of lengths (equal, and one more) by the L1 distance of their letter counts (`kd_tree`).
   A k-d tree over at most SAMPLE words, drawn by hash, cuts the space of each length into cells of some CELL words
   (more, where the vocabulary is so large that the sample cannot tell cells of that size). Every word lies in one
   cell, and travels as a query to each cell whose region is within reach. The sample decides only how evenly cells are
   filled; a length it does not hold is one cell.
3. A task builds the tree of a cell's words, searches it for the cell's queries, and checks the letters' order. It gives
   one row per word and cell: how many near words, and the best of them.

Counts grow along forms at least by the factor RATIO, so chains are short; roots are found by doubling.

A null or empty text has no words. Of rows that repeat an id and a text each counts. An empty table gives an empty
result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .grouping import groups_of
from .kd_tree import KdTree, letter_counts, one_inserted, one_replaced
from .shipping import ship
from .stored import drawn_by_hash, forget, stored
from .words import text_of

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
HELD = 200_000
SAMPLE, CELL, LEAST_SAMPLED = 50_000, 4096, 16
PORTION = 1 << 13    # queries at once
LONG_TEXT = 1 << 24  # bytes from which on runs are not listed first

MEMBER, QUERY = 1, 2


def runs(text: str, least: int) -> Counter:
    """Runs of at least so many letters, A-Z lower-cased, as Latin-1 bytes. Every other character parts runs."""
    pattern = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)
    raw = text.encode("latin-1", "replace").lower()
    if len(raw) < LONG_TEXT:
        return Counter(pattern.findall(raw))
    return Counter(found.group() for found in pattern.finditer(raw))


def shortened(doc_id: str, words: Counter, every: int) -> Counter:
    """The words, of which one in `every` (by the hash of id and word) has lost one letter."""
    start = zlib.crc32(f"{doc_id}:".encode())
    out = Counter()
    for word, n in words.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % every == 0:
            word = word[:h % len(word)] + word[h % len(word) + 1:]
        out[word] += n
    return out


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
                shorten_every: int | None = None) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences. `shorten_every` plants misspellings: of that share
    of the runs of a document, by hash, one letter is deleted. A null id counts as an empty one there."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_of().alias("text"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                           "n": pa.array(list(counts.values()), pa.int64())})

    def run(batches):
        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = runs(text, least_letters)
                if shorten_every:
                    found = shortened(doc_id, found, shorten_every)
                counts.update({w: n for w, n in found.items() if len(w) >= least_letters})
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    partial = rows.mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Cells:
    """The cells of each length's count vectors."""

    def __init__(self, sample: list[bytes], share: float):
        """`share` is the part of all words that the sample holds."""
        by_length: dict[int, list[bytes]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        size = max(LEAST_SAMPLED, round(CELL * share))
        # Count vectors of one type, so that regions hold for all.
        self.trees = {length: KdTree(letter_counts(words).astype(np.int32), size, regions=True)
                      for length, words in by_length.items() if len(words) > size}
        for tree in self.trees.values():  # regions are all that tasks need
            tree.points = tree.order = None

    def home(self, length: int, counts: np.ndarray) -> np.ndarray:
        return self.trees[length].cell_of(counts) if length in self.trees else np.zeros(len(counts), np.int64)

    def reach(self, length: int, counts: np.ndarray, distance: int):
        """(row, cell) arrays of the cells that hold words of this length within the distance."""
        if length not in self.trees:
            yield np.arange(len(counts)), np.zeros(len(counts), np.int64)
            return
        tree = self.trees[length]
        for row, node in tree.reached(counts, distance):
            yield row, tree.cell[node]


def _dealt(words: DataFrame, cells: Cells) -> DataFrame:
    """(length, cell, word, n, role): each word as member of its cell and as query of all cells within reach."""
    shared = words.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        for batch in batches:
            raw = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                counts = letter_counts([raw[r] for r in rows]).astype(np.int32)
                home = shared.value.home(int(length), counts)
                for of, distance in ((int(length), 2), (int(length) + 1, 1)):
                    for row, cell in shared.value.reach(of, counts, distance):
                        role = np.where((of == length) & (cell == home[row]), MEMBER | QUERY, QUERY)
                        at = pa.array(rows[row])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(row), of, np.int32)), pa.array(cell.astype(np.int32)),
                             batch.column("word").take(at), batch.column("n").take(at), pa.array(role.astype(np.int8))],
                            names=["length", "cell", "word", "n", "role"])

    return words.mapInArrow(run, "length int, cell int, word string, n long, role tinyint")


def _best(word: np.ndarray, near: np.ndarray, n: np.ndarray, rank: np.ndarray):
    """Of pairs (word, near): each word once, how many near ones, and the near one of largest n, ties to the first."""
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    return word[first], np.diff(np.append(first, len(word))), near[first]


def _of_cell(length: int, words: list[bytes], n: np.ndarray, role: np.ndarray):
    """(word, near words, best near word) as arrays of places in `words`, in portions."""
    member = np.flatnonzero(role & MEMBER)
    if not len(member):
        return
    query = np.flatnonzero(role & QUERY)
    counts = letter_counts(words)
    counts = counts[:, counts.any(axis=0)]
    tree = KdTree(counts[member])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    for same in (True, False):
        mine = query[(size[query] == length) == same]
        for start in range(0, len(mine), PORTION):
            some = mine[start:start + PORTION]
            pairs = [_checked(words, some[q], member[point], same, length)
                     for q, point in tree.within(counts[some], 2 if same else 1)]
            if not pairs:
                continue
            q, w = (np.concatenate(side) for side in zip(*pairs, strict=True))
            if len(q):
                yield _best(q, w, n, rank)
                if not same:  # words are queries among longer ones only
                    yield _best(w, q, n, rank)


def _checked(words: list[bytes], q: np.ndarray, w: np.ndarray, same: bool, length: int):
    keep = np.zeros(len(q), bool)
    step = max(1, (1 << 21) // length)
    for start in range(0, len(q), step):
        part = slice(start, start + step)
        a, b = [words[k] for k in q[part]], [words[k] for k in w[part]]
        keep[part] = one_replaced(a, b) if same else one_inserted(a, b)
    return q[keep], w[keep]


def _near(dealt: DataFrame, partitions: int) -> DataFrame:
    """(word, n_near, form, form_n) of the words with a near word; form is the best near word, whatever its count."""
    rows = dealt.repartition(partitions, "length", "cell").sortWithinPartitions("length", "cell")

    def run(batches):
        for cell in groups_of(batches, ["length", "cell"]):
            words = [w.encode("latin-1") for w in cell.column("word").to_pylist()]
            n = cell.column("n").to_numpy()
            for word, many, best in _of_cell(cell.column("length")[0].as_py(), words, n, cell.column("role").to_numpy()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[k].decode("latin-1") for k in word], pa.string()), pa.array(many),
                     pa.array([words[k].decode("latin-1") for k in best], pa.string()), pa.array(n[best])],
                    names=["word", "n_near", "form", "form_n"])

    partial = rows.mapInArrow(run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")))


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form) that have a form."""
    links = forms.select("word", F.col("form").alias("root")).transform(stored)
    while not links.select("root").join(links.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = (links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
                   .transform(stored))
        forget(links)
        links = further
    return links


def spelling_variants(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE) -> DataFrame:
    """For distinct words (word, n): word, form, root, n, n_near, form_n."""
    spark = words.sparkSession
    ship(spark)
    words = words.select("word", "n").transform(stored)
    total = words.count()
    drawn = drawn_by_hash(words.select("word"), "word", sample, total).collect()
    cells = Cells([row["word"].encode("latin-1") for row in drawn], len(drawn) / max(1, total))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    near = _near(_dealt(words, cells), partitions).transform(stored)
    enough = F.col("form_n") >= ratio * F.col("n")
    known = (words.join(near, "word", "left")
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
             .transform(stored))
    roots = _rooted(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
