import random
import re
from collections import Counter
from hashlib import md5
from math import floor, log, log2, sqrt

import numpy as np
from cases import documents, empty

from viaduct.llm.toxicity import (
    NEIGHBOURS, BlockMaxIndex, Model, density_steps, drop_toxic, examples, fit, score_toxicity)


def levels(draw, count, terms):
    return [{t: draw.randrange(1, 9) for t in draw.sample(range(terms), draw.randrange(0, 6))} for _ in range(count)]


def weights(worth, one):
    """The vector over the steps of the terms, spelt out."""
    vector = {(t, s): sqrt(worth[t, s + 1] - worth[t, s]) for t, l in one.items() for s in range(l)}
    size = sqrt(sum(w * w for w in vector.values()))
    return {s: w / size for s, w in vector.items()} if size else {}


def test_nearest_against_all_cosines():
    draw = random.Random(8)
    for terms in (6, 40):
        worth = np.array([np.cumsum([0.0, *(draw.random() * draw.choice([1, 30]) for _ in range(8))]) for _ in range(terms)])
        known = levels(draw, 1500, terms)
        vectors = [weights(worth, one) for one in known]
        index = BlockMaxIndex(known, worth)
        for place, query in enumerate(levels(draw, 60, terms)):
            without, vector = place if place % 2 else -1, weights(worth, query)
            cosines = [(i, sum(w * vector.get(s, 0.0) for s, w in v.items())) for i, v in enumerate(vectors) if i != without]
            expected = sorted([c for c in cosines if c[1] > 0], key=lambda c: (-round(c[1], 9), c[0]))[:NEIGHBOURS]
            found = index.nearest(query, NEIGHBOURS, without)
            assert [i for i, _ in found] == [i for i, _ in expected]
            assert np.allclose([s for _, s in found], [s for _, s in expected])


def test_density_steps():
    assert [density_steps(1, n) for n in (1, 8, 9, 16, 17, 512, 513, 10**6)] == [8, 8, 7, 7, 6, 2, 1, 1]


def labelled(spark, count=400):
    draw = random.Random(6)
    clean = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(count):
        words = [draw.choice(clean) for _ in range(draw.randrange(20, 60))]
        toxic = draw.random() < 0.2
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["fool", "rotter", "scoundrel"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(docs, known.filter("doc_id % 4 <> 2"))
    found = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    right = [found[i]["predicted"] == y for i, y in labels if i % 4 == 2]
    assert np.mean(right) >= 0.97 and all(0 <= r["score"] <= 1 for r in found.values())
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in found.items() if not r["predicted"])
    again = fit(docs.repartition(7, "text"), known.filter("doc_id % 4 <> 2").repartition(3))
    assert {r["doc_id"]: r["score"] for r in score_toxicity(docs, again).collect()} == {i: r["score"] for i, r in found.items()}


def test_odd_rows_have_the_base_rate(spark):
    rows, labels = labelled(spark, 150)
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = fit(documents(spark, rows), known)
    docs = documents(spark)
    found = score_toxicity(docs, model).collect()
    assert len(found) == docs.count()
    assert all(r["score"] == model.base for r in found if r["doc_id"] in (3, 4, 5))
    assert score_toxicity(empty(spark), model).count() == 0 and drop_toxic(empty(spark), model).count() == 0


def test_one_sided_or_no_labels(spark):
    docs = documents(spark)
    for labels in ([], [(1, 0), (2, 0)]):
        model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert isinstance(model, Model) and {r["score"] for r in score_toxicity(docs, model).collect()} == {0.0}


def test_examples_hold_one_row_per_id(spark):
    docs = documents(spark, [(1, f"text {k}") for k in range(500)] + [(2, "b"), (2, "a"), (3, "c")])
    known = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert sorted((r["doc_id"], r["toxic"], r["text"]) for r in examples(docs, known, most=9).collect()) == [
        (1, 1, "text 0"), (2, 0, "a"), (3, 0, "c")]
    assert examples(docs, known, most=2).count() == 2


def test_blocks_that_cannot_matter_are_not_read():
    # One rare, heavy term settles the neighbours; the blocks of a common one hold no example that could catch up.
    worth = np.array([[0.0, 99.0], [0.0, 1.0], [0.0, 50.0]])
    index = BlockMaxIndex([{0: 1, 1: 1} if i < 40 else {1: 1, 2: 1} for i in range(6400)], worth)
    found = index.nearest({0: 1, 1: 1}, NEIGHBOURS)
    assert [i for i, _ in found] == list(range(NEIGHBOURS)) and index.read == 2  # of 101


def pooled(votes, labels):
    """Isotonic regression by merging any two neighbouring pools that are out of order, until there are none."""
    pools = [([v], [y]) for v, y in sorted(zip(votes, labels), key=lambda p: p[0])]
    at = 0
    while at + 1 < len(pools):
        if np.mean(pools[at][1]) >= np.mean(pools[at + 1][1]):
            pools[at:at + 2] = [(pools[at][0] + pools[at + 1][0], pools[at][1] + pools[at + 1][1])]
            at = max(0, at - 1)
        else:
            at += 1
    edges = [np.mean(v) for v, _ in pools]
    rates = [(sum(y) + np.mean(v)) / (len(y) + 1) for v, y in pools]
    return edges, np.maximum.accumulate(rates)


def brute_scores(rows, labels):
    """Scores by comparing each text with every example, from the definition in the module's text."""
    text_of, label_of = dict(rows), dict(labels)

    def counts(text):
        words = re.findall(r"\w+", text.lower())
        return Counter(t for w in words for t in ["=" + w, *(w[:k] for k in (4, 5, 6, 7) if len(w) > k)]), len(words)

    ids = sorted(label_of, key=lambda i: (md5(f"examples|{i}".encode()).hexdigest(), i))
    rate = sum(label_of.values()) / len(ids)
    held, positive = Counter(), Counter()
    for i in ids:
        terms = set(counts(text_of[i])[0])
        held.update(terms)
        positive.update(terms if label_of[i] else ())
    apart = {t: (positive[t] - n * rate) / sqrt(n * rate * (1 - rate)) for t, n in held.items() if n >= 4}
    chosen = {t for t, d in apart.items() if d >= 5}
    terms = {t for t in chosen if not any(t.lstrip("=")[:k] in chosen and k < len(t) and
             (held[t], positive[t]) == (held[t.lstrip("=")[:k]], positive[t.lstrip("=")[:k]]) for k in (4, 5, 6, 7))}

    def steps(text):
        found, size = counts(text)
        return {(t, s) for t, n in found.items() if t in terms
                for s in range(max(1, min(8, floor(log2(n / size)) + 11)))}

    frequency = Counter(s for _, text in rows for s in steps(text))

    def vector(text):
        raw = {s: log((1 + len(rows)) / frequency[s]) for s in steps(text)}
        size = sqrt(sum(w * w for w in raw.values()))
        return {s: w / size for s, w in raw.items()} if size else {}

    examples_ = [vector(text_of[i]) for i in ids]
    without_terms = [label_of[i] for i, v in zip(ids, examples_) if not v]
    base = (sum(without_terms) + 0.5 * rate) / (len(without_terms) + 0.5)

    def vote(query, without=None):
        cosines = [(sum(w * v.get(s, 0) for s, w in query.items()), k) for k, v in enumerate(examples_) if k != without]
        near = sorted([(-round(c, 9), k, c) for c, k in cosines if c > 0])[:25]
        weights = [c ** 4 for _, _, c in near]
        return (sum(w * label_of[ids[k]] for w, (_, k, _) in zip(weights, near)) + base) / (sum(weights) + 1)

    placed = [k for k, v in enumerate(examples_) if v]
    edges, rates = pooled([vote(examples_[k], k) for k in placed], [label_of[ids[k]] for k in placed])
    return {i: float(np.interp(vote(vector(text)), edges, rates)) if vector(text) else base for i, text in rows}


def test_scores_against_comparing_with_every_example(spark):
    rows, labels = labelled(spark, 300)
    draw = random.Random(2)
    rows = [(i, text + " " + draw.choice(["foolish", "foolhardy", "", "", ""]) * draw.randrange(4)) for i, text in rows]
    labels = [(i, y ^ (i % 41 == 0)) for i, y in labels if i % 3]
    model = fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r["score"] for r in score_toxicity(documents(spark, rows), model).collect()}
    expected = brute_scores(rows, labels)
    assert max(abs(found[i] - expected[i]) for i in expected) < 1e-6 and len(set(found.values())) > 2
