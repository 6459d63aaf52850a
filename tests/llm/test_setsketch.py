import numpy as np
import pytest

from viaduct.llm import setsketch as s


def hashes(start, stop):
    return s.mixed(np.arange(start, stop, dtype=np.uint64) + np.uint64(1))


def test_registers_merge_by_maximum():
    one, two = hashes(0, 700), hashes(400, 5200)
    assert (s.registers(np.concatenate([one, two])) == np.maximum(s.registers(one), s.registers(two))).all()


@pytest.mark.parametrize("shared", [0, 300, 600, 900, 1000])
def test_similarity_is_estimated(shared):
    found = []
    for k in range(20):
        at = 10_000 * k
        one, two = hashes(at, at + 1000), hashes(at + 1000 - shared, at + 2000 - shared)
        found.append(s.estimate(s.registers(one)[None], s.registers(two)[None], np.array([1000]), np.array([1000]))[0])
    assert np.mean(found) == pytest.approx(shared / (2000 - shared), abs=0.04)


def test_similar_sets_share_a_band():
    for k in range(60):
        at = 10_000 * k
        one, two = hashes(at, at + 900), hashes(at + 100, at + 1000)  # similarity 0.8
        assert (s.band_keys(s.registers(one)) == s.band_keys(s.registers(two))).any()


def test_shingles_of_short_sequences():
    words = np.array([5, 6, 7], np.uint64)
    assert len(s.shingle_hashes(words, 5)) == 1 and len(s.shingle_hashes(words, 2)) == 2
    assert len(s.shingle_hashes(words[:0], 5)) == 0
    assert len(s.shingle_hashes(np.array([1, 1, 1, 1], np.uint64), 2)) == 1


def test_rows_drawn_by_hash_do_not_depend_on_partitions(spark):
    from viaduct.llm.stored import drawn_by_hash

    frame = spark.range(20_000).selectExpr("cast(id AS string) AS k")
    drawn = [sorted(r[0] for r in drawn_by_hash(f, "k", 300, 20_000).collect()) for f in (frame, frame.repartition(9))]
    assert len(drawn[0]) == 300 and drawn[0] == drawn[1]
    assert drawn_by_hash(frame.limit(10), "k", 300, 10).count() == 10
