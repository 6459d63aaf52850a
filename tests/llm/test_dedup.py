import hashlib
import random

import numpy as np
from cases import TEXTS, documents, empty

import viaduct.llm.components as components_module
import viaduct.llm.near_dedup as near_dedup_module
from viaduct.llm.bloom import bits_for, once_plane, passes, repeated_plane
from viaduct.llm.components import components
from viaduct.llm.exact_dedup import drop_duplicates, duplicate_groups
from viaduct.llm.near_dedup import drop_near_duplicates, near_duplicates


def normal(text):
    return (text or "").encode().lower()  # bytes.lower changes A-Z only


def test_filter_misses_no_repeated_hash(spark):
    draw = random.Random(3)
    values = [draw.randrange(-2**63, 2**63) for _ in range(5000)]
    twice = values[:400]
    frame = spark.createDataFrame([(v,) for v in values + twice], "h long").repartition(5)
    plane = repeated_plane(frame, 5400)
    assert len(plane) * 8 == bits_for(5400)
    assert passes(plane, np.array(twice)).all()
    assert passes(plane, np.array(values[400:])).mean() < 0.1
    assert passes(once_plane(frame, 5400), np.array(values)).all()


def test_groups_against_brute_force(spark):
    found = sorted(map(tuple, duplicate_groups(documents(spark)).collect()), key=repr)
    groups = {}
    for i, text in TEXTS:
        groups.setdefault(normal(text), []).append(i)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = [k for k, i in enumerate(ids) if i == keep][-1]
        expected += [(i, keep, len(ids), k == stays, hashlib.sha256(text).hexdigest()) for k, i in enumerate(ids)]
    assert found == sorted(expected, key=repr)


def test_dropping_keeps_one_row_of_each_text(spark):
    docs = documents(spark)
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], normal(r["text"])) for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted(
        (max(i for i, t in TEXTS if normal(t) == text and i is not None), text)
        for text in {normal(t) for i, t in TEXTS if i is not None})
    assert drop_duplicates(empty(spark)).count() == 0 and duplicate_groups(empty(spark)).count() == 0


def test_components_of_a_random_graph(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(500, 540)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: root(x) for x in list(parent)}


def counted_steps(monkeypatch, *modules):
    """A list that gets the name of every intermediate table that these modules store from now on."""
    steps = []
    for module in modules:
        def counted(frame, name="step", store=module.stored):
            steps.append(name)
            return store(frame, name)

        monkeypatch.setattr(module, "stored", counted)
    return steps


def test_components_take_few_steps(spark, monkeypatch):
    """Each step deals its rows out anew, at a cost for every partition there is, however few the rows."""
    stars = [(1000 * s + 500, 1000 * s + k) for s in range(6) for k in range(40)]  # the middle is no star's smallest
    bridges = [(1000 * s + 7, 1000 * s + 1003) for s in range(5)]
    steps = counted_steps(monkeypatch, components_module)
    found = {r["node"]: r["component"]
             for r in components(spark.createDataFrame(stars + bridges, "a long, b long")).collect()}
    assert found == {x: 0 for link in stars + bridges for x in link}
    assert len(steps) <= 14, steps


def test_near_copies_of_a_large_group_take_few_steps(spark, monkeypatch):
    draw = random.Random(17)
    words, rows = [f"w{k}" for k in range(60)], []
    for i in range(120):  # copies of copies, so that the ends of the group are no copies of each other
        words = list(words)
        words[draw.randrange(60)] = f"n{i}"
        rows.append((draw.randrange(10**4) * 1000 + i, " ".join(words)))
    steps = counted_steps(monkeypatch, components_module, near_dedup_module)
    found = near_duplicates(documents(spark, rows), shingle=4)
    assert sorted(map(tuple, found.collect())) == near_brute(rows, 4, 80)
    assert len(steps) <= 48, steps


def near_brute(rows, shingle, percent):
    sets = {}
    for i, text in rows:
        words = normal(text).split()
        k = min(shingle, len(words))
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if k else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                a, b = sets[i], sets[j]
                if a and b and 100 * len(a & b) >= percent * len(a | b) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return sorted((i, len(sets[i]), label[i], label[i] == i) for i in sets)


def test_near_copies_against_brute_force(spark):
    draw = random.Random(11)
    rows = [(i, t) for i, t in dict((i, t) for i, t in TEXTS if i is not None and i not in (9, 10, 11)).items()]
    for family in range(6):  # families whose members drift apart, linked through others or only nearly
        words = [f"f{family}w{k}" for k in range(80)]
        for member in range(9):
            words = list(words)
            for _ in range(1 + family % 3):
                words[draw.randrange(80)] = f"n{draw.randrange(10**6)}"
            rows.append((100 * (family + 1) + draw.randrange(9) * 10 + member, " ".join(words)))
    found = near_duplicates(documents(spark, rows), shingle=4)
    assert sorted(map(tuple, found.collect())) == near_brute(rows, 4, 80)


def test_near_copies_of_odd_rows(spark):
    docs = documents(spark)
    found = {r["doc_id"]: r for r in near_duplicates(docs).collect() if r["doc_id"] is not None}
    assert all(found[i]["n_shingles"] == 0 and found[i]["component_id"] == i and found[i]["kept"] for i in (3, 4, 5))
    assert found[2]["component_id"] == 1 and found[8]["component_id"] == 6 and found[10]["component_id"] == 9
    assert near_duplicates(docs).filter("doc_id IS NULL").first()["kept"]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id IN (2, 8, 10)").count() == 0
    assert kept.filter("doc_id IS NULL").count() == 1


def test_near_copies_of_one_id_on_several_texts(spark):
    def text(name, changed=None):
        return " ".join(f"{name}{k}" if k != changed else "other" for k in range(100))

    rows = [(1, text("a")), (1, text("b")), (2, text("a", 50)), (3, text("b", 50)), (6, text("a", 20)), (6, text("d")),
            (7, text("e")), (7, text("e", 30)), (8, text("f")), (8, text("g")), (8, text("g")), (9, text("g"))]
    docs = documents(spark, rows)
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert found == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (6, 1, False), (6, 6, True),
                     (7, 7, True), (7, 7, True), (8, 8, True), (8, 8, True), (8, 8, True), (9, 8, False)]
    stay = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(docs).collect()]
    assert sorted(t for i, t in stay if i != 7) == sorted(
        text(n) for n in ("a", "b", "d", "f", "g", "g")) and sum(i == 7 for i, _ in stay) == 1


def test_empty_table_has_no_near_copies(spark):
    assert near_duplicates(empty(spark)).count() == 0
