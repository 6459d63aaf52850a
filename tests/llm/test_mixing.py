import random

import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from viaduct.llm.mixing import MAX_EPOCHS, WEIGHTS, mix, plan_mix, water_fill


def filled(sizes, weights=WEIGHTS, epochs=MAX_EPOCHS):
    """Targets by clamping and sharing anew until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    clamped, total = set(), sum(sizes.values())
    while True:
        spare = total - sum(epochs * sizes[s] for s in clamped)
        free = sum(weight[s] for s in names if s not in clamped)
        target = {s: float(epochs * sizes[s]) if s in clamped else weight[s] * spare / free for s in names}
        above = {s for s in names if s not in clamped and target[s] > epochs * sizes[s]}
        if not above:
            return target
        clamped |= above


@pytest.mark.parametrize("seed", range(3))
def test_water_fill_is_the_repeated_clamping(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([0, 1, draw.randrange(10), draw.randrange(10_000)]) for i in range(12)}
    sizes[None] = draw.randrange(1000)
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in water_fill(frame).collect()}
    assert found == pytest.approx(filled(sizes))


def test_plan_meets_targets_and_caps(spark):
    docs = documents(spark)
    plan = plan_mix(docs)
    assert plan.count() == docs.count()
    assert all(0 <= r["taken"] <= MAX_EPOCHS * r["size"] for r in plan.collect())
    single = docs.filter("doc_id <> 18")
    by_source = (plan_mix(single).join(single.select("doc_id", "source"), "doc_id").groupBy("source")
                 .agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect())
    assert len(by_source) == 4 and all(abs(r["taken"] - r["target"]) <= 1 for r in by_source)


def test_plan_does_not_depend_on_partitions(spark):
    docs = documents(spark)
    assert (sorted(map(tuple, plan_mix(docs).collect()), key=repr)
            == sorted(map(tuple, plan_mix(docs.repartition(7, "text")).collect()), key=repr))


def test_mix_repeats_what_the_plan_takes(spark):
    docs = documents(spark).filter("doc_id <> 18")
    taken = {r["doc_id"]: r["taken"] for r in plan_mix(docs).collect() if r["taken"]}
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == taken


def test_empty_table_and_texts_without_words(spark):
    assert plan_mix(empty(spark)).count() == 0 and mix(empty(spark)).count() == 0
    blank = documents(spark, [(1, None), (2, ""), (3, " ")])
    assert [r["taken"] for r in plan_mix(blank).collect()] == [0, 0, 0]
    assert mix(blank).count() == 0


def test_the_part_of_a_document_keeps_its_layout(spark):
    text = " \n" + "".join(f"w{k}\t\n\n  " for k in range(50))
    rows = [(k, text) for k in range(1, 9)]
    docs = documents(spark, rows)
    plan = plan_mix(docs).collect()
    found = [(r["doc_id"], r["text"]) for r in mix(docs).collect()]
    expected, cuts = [], 0
    for r in plan:
        expected += [(r["doc_id"], text)] * (r["repeats"] + (0 < r["extra"] == r["size"]))
        if 0 < r["extra"] < r["size"]:
            word = f"w{r['extra'] - 1}\t" if r["doc_id"] != 11 else "a "
            expected.append((r["doc_id"], text[:text.index(word) + len(word) - 1]))
            cuts += 1
    assert cuts and sorted(found) == sorted(expected)


def test_no_python_in_the_plan(spark):
    for frame in (plan_mix(documents(spark)), mix(documents(spark))):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert not [bad for bad in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if bad in text]
