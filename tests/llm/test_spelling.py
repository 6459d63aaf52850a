import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import TEXTS, documents, empty
from conftest import DATA

from viaduct.llm.kd_tree import KdTree, letter_counts, one_inserted, one_replaced
from viaduct.llm.queries import QUERIES
from viaduct.llm.spelling import spelling_variants, word_counts


def brute_counts(rows, every, least=6, least_count=5):
    counts = Counter()
    for i, text in rows:
        for word in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = word.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if every and h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= least:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= least_count}


def brute_variants(counts, ratio=5):
    gaps, near = {}, {w: set() for w in counts}
    for w in counts:
        for k in range(len(w)):
            short = w[:k] + w[k + 1:]
            gaps.setdefault((k, short), set()).add(w)
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    for alike in gaps.values():
        for w in alike:
            near[w] |= alike - {w}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= ratio * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w) or "", root(w), n, len(near[w]), counts[form[w]] if w in form else -1)
                  for w, n in counts.items())


def found(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"])
                  for r in frame.collect())


def drawn(seed, n, letters="abcé\u00ff", sizes=(6, 7, 8)):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.choice(sizes))): draw.choice([5, 6, 30, 200]) for _ in range(n)}
    return words


@pytest.mark.parametrize("every", [None, 3, 199])
def test_counts_against_brute_force(spark, every):
    rows = [(i, t) for i, t in TEXTS] + [(40 + k, "Strasse STRASSE stra\u00dfe \u00c9clair\u00e9 \u00e9clair\u00e9 naïveté x\u0130yzzyz") for k in range(9)]
    docs = documents(spark, rows).repartition(3)
    assert {r["word"]: r["n"] for r in word_counts(docs, shorten_every=every).collect()} == brute_counts(rows, every)
    assert word_counts(empty(spark)).count() == 0


@pytest.mark.parametrize("sample", [50_000, 40, 1])
def test_variants_against_brute_force(spark, sample, monkeypatch):
    import viaduct.llm.spelling as module
    monkeypatch.setattr(module, "CELL", 30)
    monkeypatch.setattr(module, "LEAST_SAMPLED", 2)
    words = drawn(1, 900) | drawn(2, 60, "ab", (9,)) | {"a" * 3000: 5, "a" * 3001: 50, "abcdefg": 5, "gfedcba": 900}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert found(spelling_variants(frame, sample=sample)) == brute_variants(words)


def test_forms_lead_to_a_root_and_ties_to_the_smallest_word(spark):
    words = {"banana": 5, "bananas": 25, "bananass": 130, "bananassu": 700, "cherry": 5, "cherrx": 40, "cherrz": 40}
    rows = {r[0]: r for r in found(spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert [rows[w][2] for w in list(words)[:4]] == ["bananassu"] * 4
    assert rows["cherry"][1:3] == ("cherrx", "cherrx") and rows["cherrx"][1:5] == ("", "cherrx", 40, 2)
    nothing = spelling_variants(spark.createDataFrame([], "word string, n long"))
    assert found(nothing) == []


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_variants(brute_counts(rows, 199))
    assert len(expected) > 500 and found(QUERIES["op11_spelling_variants"](spark, DATA)) == expected


@pytest.mark.parametrize("regions", [False, True])
def test_searches_reach_all_points_within_the_distance(regions):
    words = [w.encode("latin-1") for w in drawn(3, 700, "abcdef", (7,))]
    counts = letter_counts(words)
    assert counts.sum(axis=1).tolist() == [7] * len(words) and letter_counts([]).shape == (0, 90)
    tree = KdTree(counts[100:].astype(np.int32), 5, regions=regions)
    far = np.abs(counts[:, None].astype(int) - counts[None, 100:]).sum(axis=2)
    for distance in (0, 2, 4):
        pairs = {(int(q), int(p)) for a, b in tree.within(counts, distance) for q, p in zip(a, b)}
        assert pairs == set(zip(*map(np.ndarray.tolist, np.nonzero(far == distance))))
    home = tree.cell_of(counts)
    reached = {(int(q), int(tree.cell[n])) for a, b in tree.reached(counts, 0) for q, n in zip(a, b)}
    assert not regions or reached == set(enumerate(home.tolist()))


def test_equal_points_make_one_leaf():
    assert KdTree(np.ones((500, 4), np.int8), 3).leaves == 1


def test_letter_order():
    assert one_replaced([b"abcdef"] * 3, [b"abcdef", b"abXdef", b"bacdef"]).tolist() == [False, True, False]
    assert one_inserted([b"abcd"] * 6, [b"xabcd", b"abcdx", b"abxcd", b"abccd", b"xbcda", b"dcbax"]).tolist() == [
        True, True, True, True, False, False]
