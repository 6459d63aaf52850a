import hashlib

import numpy as np
import pytest
from cases import vectors

from viaduct.llm.compression import Bounds, assign, compress, vector_codes

NAN, INF = float("nan"), float("inf")


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes by full scans, for usable rows of (id, vector, label)."""
    x = np.floor(np.array([v for _, v, _ in rows], np.float32).astype(np.float64) * 256).astype(np.int64)
    x = x.reshape(len(x), parts, -1)
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, x[r].tolist()))
    books = x[order[:entries]].transpose(1, 0, 2).copy()
    history = [books]
    for step in range(rounds + 1):
        far = ((x.transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(axis=3)
        own, error = far.argmin(axis=2), far.min(axis=2).sum(axis=0)
        if step < rounds:
            books = books.copy()
            for part in range(parts):
                for entry in set(own[part]):
                    mine = x[own[part] == entry, part]
                    books[part, entry] = [int(s) // len(mine) for s in mine.sum(axis=0)]
            history.append(books)
    return x, own.T, error, history


def expected(rows):
    _, own, error, history = brute(rows)
    sums = {}
    for (_, _, label), e in zip(rows, error):
        sums[label] = sums.get(label, 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, history[-1].ravel().tolist())).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for k in codes), int(e), sums[label], digest)
                   for (i, _, label), codes, e in zip(rows, own, error)), key=repr)


def drawn(n, size=32, seed=0):
    draw = np.random.default_rng(seed)
    return [(k * 3 % n, (draw.normal(size=size) / 4).astype(np.float32).tolist(), [None, 1, 2][k % 3]) for k in range(n)]


@pytest.mark.parametrize("rows", [
    drawn(301), drawn(40, 16), drawn(1), [(i, [0.5] * 16, None) for i in range(100)],
    drawn(90) + drawn(90) + [(None, [0.1] * 32, 7), (None, [0.2] * 32, 7)],
    [(i, [(-1) ** i * (i % 5) * 1000.0] * 32, i % 2) for i in range(200)],
], ids=["random", "short", "one", "equal", "repeated and null ids", "ties and wide"])
def test_codes_against_full_scans(spark, rows):
    found = vector_codes(vectors(spark, rows).repartition(3))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_unusable_vectors_are_dropped(spark):
    good = drawn(70)
    bad = [(900, None, 1), (901, [], 1), (902, [None] + [0.0] * 31, 1), (903, [NAN] * 32, 2), (904, [INF] + [0.0] * 31, 2)]
    assert sorted(map(tuple, vector_codes(vectors(spark, good + bad)).collect()), key=repr) == expected(good)
    assert vector_codes(vectors(spark, bad)).count() == 0 and vector_codes(vectors(spark, [])).count() == 0


def test_vectors_that_cannot_be_cut_are_refused(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(vectors(spark, [(1, [0.0] * 17, 1)]))
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(vectors(spark, [(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)]))


def test_bounds_spare_scans_and_change_nothing():
    rows = drawn(2000)
    x, own, _, history = brute(rows, rounds=4)
    bounds, scans = Bounds.none(len(x), 16, 8), []
    for step in range(len(history)):
        bounds, error, scanned = assign(x, bounds, history[:step + 1])
        scans.append(scanned / (len(x) * 16 * 8))
    assert (bounds.own == own).all() and (error == ((x - np.stack(
        [history[-1][p][own[:, p]] for p in range(16)], axis=1)) ** 2).sum(axis=2)).all()
    assert scans[0] == 1 and max(scans[1:]) < 0.6 and scans[-1] < scans[1]


def test_net_displacement_is_tighter_than_the_sum_of_moves():
    from viaduct.llm.compression import displacements
    there, away = np.zeros((1, 8, 2), np.int64), np.full((1, 8, 2), 30, np.int64)
    assert displacements([there, away, there])[0, 0, 0] == 0 and displacements([there, away])[0, 0, 0] > 42


def test_codes_can_be_decoded(spark):
    rows = drawn(301)
    coded, books = compress(vectors(spark, rows))
    found = coded.orderBy("id").collect()
    codes = np.array([list(bytes.fromhex(r["code"])) for r in found])
    x = brute(sorted(rows, key=lambda r: r[0]))[0].reshape(len(rows), -1)
    assert [r["error"] for r in found] == ((x - books.decode(codes)) ** 2).sum(axis=1).tolist()
