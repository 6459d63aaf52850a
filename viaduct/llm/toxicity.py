"""Toxicity by the nearest labelled examples.

Texts become TF-IDF vectors over a vocabulary of terms that go with the label: whole words, and beginnings of words,
which stand for the compounds of a stem. A term enters by how densely a text uses it, in steps of a factor of two, so
that each step is a term of its own with its own inverse document frequency. Scores are found in three parts:

* `fit` draws at most MOST_EXAMPLES labelled rows by the hash of their ids, chooses the vocabulary by how far the
  terms' label counts depart from chance, counts document frequencies over all documents of the corpus, and builds an
  inverted index of the examples whose lists are cut into blocks with the largest weight of each (`BlockMaxIndex`).
* Scoring finds the NEIGHBOURS examples of largest cosine exactly: lists are read in order of their largest possible
  contribution, blocks that cannot lift an example above the worst neighbour are not read, and examples that are left
  are scored in full. Votes are weighted by a power of the similarity, with a share of the vote for the base rate.
* The vote becomes a probability by isotonic regression on the examples, each scored without itself.

A document without any term of the vocabulary, such as an empty one, has the base rate of the examples without terms.
The label is the only label that is read; language, source and id are no inputs. Rows whose label is null teach
nothing; an id with conflicting labels counts as toxic. Without examples of both labels every score is the base rate (0 without any labelled row).

Null texts count as empty. Whole texts are read. Repeated rows are scored alike; ties of similarity go to the example
that comes first by hash. An empty table gives an empty result. Columns other than doc_id, text (and the label table's
doc_id and toxic) are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from math import floor, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .merging import Remembered, begin_task
from .shipping import ship
from .words import text_of

MOST_EXAMPLES = 20_000   # labelled rows that are learned from
MOST_TERMS = 4_096       # words and stems in the vocabulary
LEAST_ROWS = 4           # labelled rows with a term
LEAST_DEPARTURE = 5.0    # standard deviations that a term's positive count exceeds chance
STEMS = (4, 5, 6, 7)     # letters of a word's beginning that are terms
STEPS = 8                # steps of density, from 1 in 2 ** (STEPS + 2) words on, by a factor of two
NEIGHBOURS = 25
POWER = 4                # of the similarity, as the weight of a vote
BASE_VOTES = 1.0         # votes for the base rate
BLOCK = 64
THRESHOLD = 0.3
EVIDENCE = 5
PORTION_ROWS = 512

_words = re.compile(r"\w+").findall


def word_terms(word: str) -> tuple[str, ...]:
    """The terms of a word: itself, marked as whole, and its beginnings."""
    return ("=" + word, *(word[:size] for size in STEMS if len(word) > size))


def density_steps(count: int, words: int) -> int:
    """How many of the steps 2 ** -(STEPS + 2), ..., 2 ** -3 a term's share of the words reaches; at least one."""
    return max(1, min(STEPS, floor(log2(count / words)) + STEPS + 3))


class Vectorizer:
    """Texts to the levels of their terms: how many steps of density each reaches."""

    def __init__(self, terms: list[str]):
        self.place = {term: i for i, term in enumerate(terms)}
        self.known = Remembered(self._terms_of, 32 << 20)

    def _terms_of(self, word: str) -> tuple[int, ...]:
        return tuple([self.place[t] for t in word_terms(word) if t in self.place])

    def levels(self, text: str) -> dict[int, int]:
        self.known.trim()
        words = _words(text.lower())
        counts: Counter = Counter()
        for terms in map(self.known.__getitem__, words):
            if terms:
                counts.update(terms)
        return {term: density_steps(count, len(words)) for term, count in counts.items()}


class BlockMaxIndex:
    """Examples by term, with the largest weight of every block, for exact nearest neighbours by cosine.

    `worth[t, l]` is the sum of the squared weights of the first l steps of term t. As a text that reaches a step has
    all steps below it, the product of two texts' vectors at a term is the worth of the lower level, and one list per
    term serves all its steps.
    """

    def __init__(self, examples: list[dict[int, int]], worth: np.ndarray):
        self.worth = worth
        sizes = np.fromiter(map(len, examples), np.int64, len(examples))
        self.ends = np.cumsum(sizes)
        self.terms = np.fromiter((t for e in examples for t in e), np.int32, int(sizes.sum()))
        self.levels = np.fromiter((l for e in examples for l in e.values()), np.int8, len(self.terms))
        norms = np.zeros(len(examples))
        np.add.at(norms, np.repeat(np.arange(len(examples)), sizes), worth[self.terms, self.levels])
        self.inverse = np.append(1.0 / np.sqrt(np.where(norms > 0, norms, np.inf)), 0.0)
        # Blocks are rows of BLOCK postings; what fills the last one up is an example that does not exist.
        nobody, steps = len(examples), worth.shape[1]
        owner = np.repeat(np.arange(len(examples), dtype=np.int32), sizes)
        order = np.lexsort((owner, self.terms))
        self.lists, self.best = {}, {}
        for part in np.split(order, np.flatnonzero(np.diff(self.terms[order])) + 1) if len(order) else ():
            term, blocks = int(self.terms[part[0]]), -(-len(part) // BLOCK)
            ids, levels = np.full(blocks * BLOCK, nobody, np.int32), np.zeros(blocks * BLOCK, np.int8)
            ids[:len(part)], levels[:len(part)] = owner[part], self.levels[part]
            ids, levels = ids.reshape(blocks, BLOCK), levels.reshape(blocks, BLOCK)
            tops = np.stack([(worth[term, np.minimum(levels, k)] * self.inverse[ids]).max(axis=1)
                             for k in range(steps)], axis=1)
            last = np.where(ids < nobody, ids, -1).max(axis=1)
            self.lists[term] = ids, levels, tops, ids[:, 0], last
            self.best[term] = tops.max(axis=0)
        self.read = 0  # blocks, for tests

    def nearest(self, query: dict[int, int], count: int, without: int = -1) -> list[tuple[int, float]]:
        """The `count` examples of largest cosine above 0 with a text of these levels, ties by place; `without` is left
        out.

        Lists come in order of their largest contribution. Once the rest of the lists together could not lift an
        unseen example above the worst of the `count` best partial sums, a block is read only if it could still admit
        an example or if an example between its first and its last has been admitted; other blocks are not touched.
        """
        size = sqrt(sum([self.worth[t, l] for t, l in query.items()]))
        if not size:
            return []
        lists = sorted(((self.best[t][l], t, l) for t, l in query.items() if t in self.lists), reverse=True)
        if not lists:
            return []
        rest = np.append(np.cumsum([top for top, _, _ in lists][::-1])[::-1], 0.0)
        sums = np.zeros(len(self.inverse))
        worst = most = 0.0
        admitted = None  # places of admitted examples, counted up, once blocks are left out
        for place, (_, term, level) in enumerate(lists):
            ids, levels, tops, first, last = self.lists[term]
            # A block matters to an example outside the sums if its top and all later lists reach the worst.
            if worst:
                able = tops[:, level] + rest[place + 1] >= worst * (1 - 1e-9)
                if not able.all():
                    if admitted is None:
                        admitted = np.append(0, np.cumsum(sums[:-1] > 0))
                    able |= admitted[last + 1] > admitted[first]
                    ids, levels = ids[able], levels[able]
            self.read += len(ids)
            if not len(ids):
                continue
            sums[ids] += self.worth[term, np.minimum(levels, level)] * self.inverse[ids]
            # The worst matters once the later lists together reach no further than the best sum so far. It is looked
            # up after the first lists and then ever more rarely, as it moves less and less.
            most = max(most, sums[ids].max())
            if rest[place + 1] <= most and (place & (place + 1)) == 0:
                held = sums[sums > 0]
                if len(held) > count:
                    worst = np.partition(held, -count - 1)[-count - 1]
            admitted = None
        sums = sums[:-1]
        if without >= 0:
            sums[without] = 0.0
        order = np.flatnonzero(sums > 0)
        # Sums of examples that were admitted late lack early lists; those who might be nearest are scored in full.
        if len(order) > count:
            edge = np.partition(sums[order], -count)[-count]
            order = order[sums[order] >= edge * (1 - 1e-9)]
        exact = self._products(order, query) * self.inverse[order] / size
        return sorted(zip(order.tolist(), exact.tolist(), strict=True), key=lambda pair: (-round(pair[1], 9), pair[0]))[:count]

    def _products(self, examples: np.ndarray, query: dict[int, int]) -> np.ndarray:
        """Of each example, all of which have terms, the worth that it shares with the query."""
        own = np.zeros(len(self.worth), np.int8)
        own[list(query)] = list(query.values())
        sizes = self.ends[examples] - np.where(examples > 0, self.ends[examples - 1], 0)
        starts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(starts, sizes) + np.repeat(self.ends[examples] - sizes, sizes)
        return np.add.reduceat(self.worth[self.terms[at], np.minimum(self.levels[at], own[self.terms[at]])], starts)


@dataclass
class Model:
    terms: list[str]
    worth: np.ndarray                    # term, level -> squared inverse document frequencies of the steps up to it
    examples: list[dict[int, int]]       # levels of the terms of each
    labels: np.ndarray
    ids: list
    base: float                          # rate among examples without terms
    edges: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    rates: np.ndarray = field(default_factory=lambda: np.array([0.0]))

    def __post_init__(self):
        self.vectorizer = Vectorizer(self.terms)
        self.index = BlockMaxIndex(self.examples, self.worth)
        self.found = Remembered(self._score_of, 16 << 20)

    def __getstate__(self):
        # The examples are in the index, as arrays.
        return {**self.__dict__, "vectorizer": None, "found": None, "examples": None}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.vectorizer, self.found = Vectorizer(self.terms), Remembered(self._score_of, 16 << 20)

    def vote(self, levels: dict[int, int], without: int = -1) -> tuple[float, list]:
        near = self.index.nearest(levels, NEIGHBOURS, without)
        weights = [similarity ** POWER for _, similarity in near]
        yes = sum([w * self.labels[i] for w, (i, _) in zip(weights, near, strict=True)])
        return (yes + BASE_VOTES * self.base) / (sum(weights) + BASE_VOTES), near

    def _score_of(self, levels: tuple[tuple[int, int], ...]) -> tuple[float, str]:
        if not levels or not any(self.worth[t, l] for t, l in levels):
            return float(self.base), ""
        vote, near = self.vote(dict(levels))
        evidence = [f"{self.ids[i]}:{int(self.labels[i])}:{similarity:.3f}" for i, similarity in near[:EVIDENCE]]
        return float(np.interp(vote, self.edges, self.rates)), ",".join(evidence)

    def score(self, text: str) -> tuple[float, str]:
        """Probability of the label, and the nearest examples as id:label:similarity."""
        self.found.trim()
        return self.found[tuple(sorted(self.vectorizer.levels(text).items()))]

    def begin(self) -> None:
        """At the start of a task: lets the tables of other operators in this worker go."""
        begin_task(self.found, self.vectorizer.known)

    def calibrate(self, placed: list[int], votes: np.ndarray) -> None:
        """Isotonic regression of the labels on the votes that the examples in these places get from the others."""
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # sum of votes, sum of labels, rows
        for vote, label in zip(votes[order], self.labels[placed][order], strict=True):
            pools.append([vote, label, 1])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        if pools:
            self.edges = np.array([p[0] / p[2] for p in pools])
            # One row's worth of the pool's mean vote keeps small pools from claiming certainty.
            self.rates = np.array([(p[1] + p[0] / p[2]) / (p[2] + 1) for p in pools])
            self.rates = np.maximum.accumulate(self.rates)


def _labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic), one row per id; an id with conflicting labels counts as toxic."""
    return (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))


def examples(docs: DataFrame, labels: DataFrame, most: int = MOST_EXAMPLES) -> DataFrame:
    """At most `most` labelled rows, the first by the hash of their ids: doc_id, text, toxic. A random sample that
    does not depend on how the tables are partitioned. Of rows that share an id the one whose text is first in order
    stands for all."""
    order = F.md5(F.concat(F.lit("examples|"), F.col("doc_id").cast("string")).cast("binary"))
    drawn = _labels(labels).withColumn("_order", order).orderBy("_order", "doc_id").limit(most)
    return (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(drawn), "doc_id")
            .groupBy("doc_id", "toxic", "_order").agg(F.min("text").alias("text")))


def _term_counts(drawn: DataFrame) -> DataFrame:
    """(term, rows, positive) over the examples: rows with the term, and those with the label."""
    def run(batches):
        rows, positive = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                terms = {term for word in set(_words(text.lower())) for term in word_terms(word)}
                rows.update(terms)
                if toxic:
                    positive.update(terms)
        terms = list(rows)
        for at in range(0, len(terms), 50_000):
            part = terms[at:at + 50_000]
            yield pa.RecordBatch.from_pydict({
                "term": pa.array(part, pa.string()), "rows": pa.array([rows[t] for t in part], pa.int64()),
                "positive": pa.array([positive[t] for t in part], pa.int64())})

    counted = drawn.select("text", "toxic").mapInArrow(run, "term string, rows bigint, positive bigint")
    return counted.groupBy("term").agg(F.sum("rows").alias("rows"), F.sum("positive").alias("positive"))


def _vocabulary(drawn: DataFrame, rows: int, positive: int) -> list[str]:
    rate = positive / rows
    departure = (F.col("positive") - F.col("rows") * rate) / F.sqrt(F.col("rows") * rate * (1 - rate))
    chosen = (_term_counts(drawn).filter(F.col("rows") >= LEAST_ROWS).withColumn("d", departure)
              .filter(F.col("d") >= LEAST_DEPARTURE).orderBy(F.desc("d"), "term").limit(MOST_TERMS)
              .select("term", "rows", "positive").collect())
    # A term that occurs in just the rows of a beginning of it says nothing more.
    seen = {(row["term"], row["rows"], row["positive"]) for row in chosen}
    return [row["term"] for row in chosen if not any(
        (row["term"].removeprefix("=")[:size], row["rows"], row["positive"]) in seen
        for size in STEMS if size < len(row["term"]))]


def _document_frequencies(docs: DataFrame, terms: list[str]) -> np.ndarray:
    """(term, step) -> documents that reach the step, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        vectorizer, counts = Vectorizer(shared.value), np.zeros((len(shared.value), STEPS + 1), np.int64)
        begin_task(vectorizer.known)
        for batch in batches:
            for text in batch.column("text"):
                for term, level in vectorizer.levels(text.as_py()).items():
                    counts[term, level] += 1
        term, level = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": pa.array(term), "level": pa.array(level), "n": pa.array(counts[term, level])})

    counted = docs.select(text_of().alias("text")).mapInArrow(run, "term bigint, level bigint, n bigint")
    at_level = np.zeros((len(terms), STEPS + 1), np.int64)
    for row in counted.groupBy("term", "level").agg(F.sum("n").alias("n")).collect():
        at_level[row["term"], row["level"]] = row["n"]
    return np.cumsum(at_level[:, :0:-1], axis=1)[:, ::-1]


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_EXAMPLES) -> Model:
    """A model from the labelled documents. What reaches the driver is bounded: the examples' levels, at most
    MOST_TERMS terms and STEPS counts for each."""
    ship(docs.sparkSession)
    drawn = examples(docs, labels, most).checkpoint()
    sums = drawn.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("positive")).first()
    if not 0 < sums["positive"] < sums["rows"]:
        base = float(sums["positive"] > 0)
        return Model([], np.zeros((0, STEPS + 1)), [], np.zeros(0), [], base)
    terms = _vocabulary(drawn, sums["rows"], sums["positive"])
    frequencies = _document_frequencies(docs, terms)
    weights = np.where(frequencies > 0, np.log((1 + docs.count()) / np.maximum(frequencies, 1)), 0.0)
    worth = np.concatenate([np.zeros((len(terms), 1)), np.cumsum(np.maximum(weights, 0.0) ** 2, axis=1)], axis=1)
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    kinds = drawn.select("doc_id", "toxic", "_order", F.lit(None).cast("array<int>").alias("terms"),
                         F.lit(None).cast("array<int>").alias("levels")).schema

    def run(batches):
        vectorizer = Vectorizer(shared.value)
        begin_task(vectorizer.known)
        for batch in batches:
            levels = [dict(sorted(vectorizer.levels(text.as_py()).items())) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "_order": batch.column("_order"),
                "terms": pa.array(map(list, levels), pa.list_(pa.int32())),
                "levels": pa.array([list(one.values()) for one in levels], pa.list_(pa.int32()))})

    rows = drawn.select("doc_id", "text", "toxic", "_order").mapInArrow(run, kinds)
    rows = sorted(rows.collect(), key=lambda r: r["_order"])
    labels_of = np.array([float(row["toxic"] > 0) for row in rows])
    empty = np.array([not row["terms"] for row in rows])
    base = (labels_of[empty].sum() + 0.5 * labels_of.mean()) / (empty.sum() + 0.5)
    model = Model(terms, worth, [dict(zip(row["terms"], row["levels"], strict=True)) for row in rows], labels_of,
                  [row["doc_id"] for row in rows], float(base))
    model.calibrate(*_left_out_votes(docs.sparkSession, model))
    return model


def _left_out_votes(spark: SparkSession, model: Model) -> tuple[list[int], np.ndarray]:
    """The examples that have terms, and the vote that each gets from the others; searched in tasks."""
    shared = spark.sparkContext.broadcast(model)
    placed = [i for i, levels in enumerate(model.examples) if levels]
    partitions = min(4 * spark.sparkContext.defaultParallelism, 1 + len(placed) // 64)
    rows = spark.createDataFrame([(i, list(levels), list(levels.values())) for i, levels in enumerate(model.examples)
                                  if levels], "place int, terms array<int>, levels array<int>").repartition(partitions)

    def run(batches):
        shared.value.begin()
        for batch in batches:
            votes = [shared.value.vote(dict(zip(terms, levels, strict=True)), without=i)[0]
                     for i, terms, levels in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)]
            yield pa.RecordBatch.from_pydict({"place": batch.column("place"), "vote": pa.array(votes, pa.float64())})

    found = sorted(map(tuple, rows.mapInArrow(run, "place int, vote double").collect())) if placed else []
    shared.unpersist()
    return [place for place, _ in found], np.array([vote for _, vote in found])


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, score, predicted, evidence (nearest examples as id:label:similarity)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", text_of().alias("text"))
    kinds = rows.select("doc_id", F.lit(0.0).alias("score"), F.lit("").alias("evidence")).schema

    def run(batches):
        shared.value.begin()
        for batch in batches:
            found = [shared.value.score(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array([s for s, _ in found], pa.float64()),
                "evidence": pa.array([e for _, e in found], pa.string())})

    return (rows.mapInArrow(run, kinds)
            .select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns. Rows are judged where they are, without a join."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    rows = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        shared.value.begin()
        for batch in batches:
            # One text at a time, and the rows that stay are sliced out in a portion each: neither all texts nor
            # all rows of a batch exist twice.
            for start in range(0, batch.num_rows, PORTION_ROWS):
                some = batch.slice(start, PORTION_ROWS)
                keep = [shared.value.score(text.as_py() or "")[0] < threshold for text in some.column(at)]
                yield some.filter(pa.array(keep, pa.bool_()))
        shared.value.begin()

    return rows.mapInArrow(run, rows.schema)
