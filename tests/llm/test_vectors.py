import numpy as np
import pytest
from cases import vectors

from viaduct.llm import cover_tree
from viaduct.llm.cover_tree import RADII, CoverTree, Tiles, Traversal, distance, heads
from viaduct.llm.vector_dedup import _keyed, linked_vectors, main_directions, plan

NAN, INF = float("nan"), float("inf")


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def drawn(n, size, groups, spread, seed=0):
    draw = np.random.default_rng(seed)
    middle = unit(draw.normal(size=(groups, size)))
    return unit(middle[draw.integers(0, groups, n)] + draw.normal(size=(n, size)) * spread / size ** 0.5)


SHAPES = [(1, 4, 1, .1), (2, 3, 1, .01), (300, 3, 300, 0), (500, 8, 20, .3), (400, 64, 400, 0), (400, 64, 3, .3),
          (400, 64, 3, .02), (900, 16, 10, .6)]


@pytest.mark.parametrize("shape", SHAPES, ids=str)
def test_levels_are_nested_cover_and_keep_apart(shape):
    x = drawn(*shape)
    tree, order = CoverTree.over(x, np.ones(len(x), np.int64))
    assert sorted(order) == list(range(len(x))) and np.array_equal(tree.x, x[order])
    far = distance(tree.x @ tree.x.T)
    for i, radius in enumerate(RADII):
        nodes = tree.levels[i]
        between = far[np.ix_(nodes.centre, nodes.centre)][~np.eye(len(nodes.centre), dtype=bool)]
        assert not len(between) or between.min() > radius - 1e-7
        assert far[:, nodes.centre].min(axis=1).max() <= radius + 1e-7
        assert set(nodes.centre) <= set(tree.levels[i + 1].centre)
        for centre, start, end, reach in zip(nodes.centre, nodes.start, nodes.end, nodes.radius):
            assert far[centre, start:end].max() <= reach + 1e-7


def grouped(linked):
    label = np.arange(len(linked))
    for _ in label:
        label = np.array([label[row].min() for row in linked])
    return label


@pytest.mark.parametrize("shape", SHAPES, ids=str)
def test_traversal_finds_all_pairs(shape):
    x = drawn(*shape)
    x[len(x) // 3] = x[len(x) // 2]
    weight = np.arange(len(x)) % 3 + 1
    tree, _ = CoverTree.over(x, weight)
    linked = tree.x @ tree.x.T >= 0.9
    np.fill_diagonal(linked, True)
    found = Traversal(tree, tree, 0.9)
    assert np.array_equal(found.gain, linked @ tree.weight)
    assert len(set(zip(found.groups.label, grouped(linked)))) == len(set(found.groups.label)) == len(set(grouped(linked)))
    one, _ = CoverTree.over(x[:len(x) // 2 + 1], weight[:len(x) // 2 + 1])
    found, across = Traversal(one, tree, 0.9), one.x @ tree.x.T >= 0.9
    assert np.array_equal(found.gain, np.concatenate([across @ tree.weight, across.T @ one.weight]))


def test_groups_of_copies_are_settled_without_their_pairs():
    tree, _ = CoverTree.over(drawn(3000, 64, 3, .02), np.ones(3000, np.int64))
    assert Traversal(tree, tree, 0.9).looked_at < 3000


def test_points_without_structure_are_looked_at_once_and_in_tiles(monkeypatch):
    tree, _ = CoverTree.over(drawn(2000, 64, 2000, 0), np.ones(2000, np.int64))
    other, _ = CoverTree.over(drawn(1500, 64, 1500, 0, seed=1), np.ones(1500, np.int64))
    judged, judge = [], Traversal._judged
    monkeypatch.setattr(Traversal, "_judged", lambda *given: judged.append(len(given[2])) or judge(*given))
    assert Traversal(tree, tree, 0.9).looked_at <= 1 + 2000 * (2000 + cover_tree.TILE) // 2
    assert Traversal(tree, other, 0.9).looked_at <= 1 + 2000 * 1500
    assert sum(judged) == 2  # the roots


def with_basis(tree, basis):
    tree.head = heads(tree.x, basis)
    return tree


@pytest.mark.parametrize("columns", [1, 7, 24, 63, 64])
@pytest.mark.parametrize("tile", [9, 512])
@pytest.mark.parametrize("shape", [(400, 64, 400, 0), (500, 64, 60, .45), (400, 64, 3, .44)], ids=str)
def test_bounds_over_some_columns_lose_no_pair(shape, tile, columns, monkeypatch):
    monkeypatch.setattr(cover_tree, "TILE", tile)
    basis = np.linalg.qr(np.random.default_rng(2).normal(size=(64, 64)))[0][:, :columns]
    x, weight = drawn(*shape), np.arange(shape[0]) % 3 + 1
    tree, order = CoverTree.over(x, weight)
    one, _ = CoverTree.over(x[order[::3]], weight[order[::3]])
    tree, one = with_basis(tree, basis), with_basis(one, basis)
    linked, across = tree.x @ tree.x.T >= 0.9, one.x @ tree.x.T >= 0.9
    np.fill_diagonal(linked, True)
    found = Traversal(tree, tree, 0.9)
    assert np.array_equal(found.gain, linked @ tree.weight)
    assert len(set(zip(found.groups.label, grouped(linked)))) == len(set(found.groups.label)) == len(set(grouped(linked)))
    assert np.array_equal(Traversal(one, tree, 0.9).gain,
                          np.concatenate([across @ tree.weight, across.T @ one.weight]))


@pytest.mark.parametrize("settings", [
    {"HEAVY": 8, "ROOM": 100, "DIRECT": 0, "LISTED": 0}, {"HEAVY": 8, "ROOM": 100, "DIRECT": 0, "LISTED": 60, "CALL": 0},
    {"HEAVY": 1 << 20, "LISTED": 30, "CALL": 0, "SMALL": 0, "TILE": 16}, {"DIRECT": 1 << 40, "LISTED": 1 << 40, "CALL": 0},
], ids=["nodes only", "products that end in tiles", "lists that end in tiles", "tiles only"])
@pytest.mark.parametrize("shape", SHAPES, ids=str)
def test_every_way_down_finds_all_pairs(shape, settings, monkeypatch):
    x, weight = drawn(*shape), np.arange(shape[0]) % 3 + 1
    tree, order = CoverTree.over(x, weight)
    one, _ = CoverTree.over(x[order[::2]], weight[order[::2]])
    for name, value in settings.items():
        monkeypatch.setattr(cover_tree, name, value)
    linked, across = tree.x @ tree.x.T >= 0.9, one.x @ tree.x.T >= 0.9
    np.fill_diagonal(linked, True)
    found = Traversal(tree, tree, 0.9)
    assert np.array_equal(found.gain, linked @ tree.weight)
    assert len(set(zip(found.groups.label, grouped(linked)))) == len(set(found.groups.label)) == len(set(grouped(linked)))
    assert np.array_equal(Traversal(one, tree, 0.9).gain,
                          np.concatenate([across @ tree.weight, across.T @ one.weight]))


def test_pairs_at_the_threshold_are_decided_in_double_precision():
    draw = np.random.default_rng(3)
    a = unit(draw.normal(size=(64, 64)))
    side = draw.normal(size=(64, 64))
    side = unit(side - np.einsum("ij,ij->i", side, a)[:, None] * a)
    # Of every pair the cosine lies some 1e-12 beside the threshold, which single precision does not tell.
    cosine = 0.9 + np.where(np.arange(64) % 2, 1e-12, -1e-12)[:, None]
    x = np.concatenate([a, cosine * a + np.sqrt(1 - cosine * cosine) * side])
    for basis in (None, np.eye(64)[:, :20]):
        tree, order = CoverTree.over(x, np.ones(128, np.int64))
        found = Traversal(with_basis(tree, basis), tree, 0.9)
        assert found.looked_at >= 128 * 128
        assert sorted(order[found.gain == 2]) == [k for k in range(128) if k % 2]


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (512, 512), (512, 7), (100, 300)])
def test_tiles_give_the_pairs_that_reach_the_bound(shape):
    draw, tiles = np.random.default_rng(4), Tiles()
    for _ in range(3):  # in memory that holds what the last tile left
        a, b = (draw.normal(size=(n, 5)).astype(np.float32) for n in shape)
        for least in (-100, 0, 5, 100):
            assert np.array_equal(tiles.reached(a, b, np.float32(least)), np.flatnonzero(a @ b.T >= least))


def test_main_directions_are_few_where_these_tell():
    assert main_directions(drawn(500, 64, 500, 0), 0.9).shape[1] < 64
    flat = np.zeros((500, 64))
    flat[:, :4] = drawn(500, 4, 500, 0)
    assert main_directions(flat, 0.9).shape == (64, 8)
    assert main_directions(drawn(1, 64, 1, 0), 0.9) is None
    basis = main_directions(drawn(90, 20, 90, 0), 0.9)
    assert basis is None or np.allclose(basis.T @ basis, np.eye(basis.shape[1]))


def brute(rows):
    usable = {k: np.array(v, np.float64) for k, (_, v, _) in enumerate(rows)
              if v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = list(range(len(rows)))
    links = [(a, b) for a in usable for b in usable if a != b and len(usable[a]) == len(usable[b])
             and usable[a] @ usable[b] / (np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])) >= 0.9]
    for _ in rows:
        for a, b in links:
            label[b] = min(label[a], label[b])
    out = []
    for k, (i, _, _) in enumerate(rows):
        names = [rows[m][0] for m in range(len(rows)) if label[m] == label[k] and rows[m][0] is not None]
        first = min(names) if names else None
        out.append((i, sum(a == k for a, _ in links), first, i == first))
    return sorted(out, key=repr)


def as_rows(x, start=0):
    return [(start + k, np.float32(v).tolist(), k % 2) for k, v in enumerate(x)]


@pytest.mark.parametrize("rows", [
    as_rows(drawn(150, 8, 12, .3)), as_rows(drawn(60, 64, 60, 0)), [(k, [0.5, -0.5], 1) for k in range(80)], [],
    as_rows(drawn(40, 8, 5, .2)) + as_rows(drawn(40, 8, 5, .2)) + as_rows(drawn(30, 3, 4, .1), 200),
    [(5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [None, 1.0], 1), (9, [NAN, 1.0], 2), (10, [INF, 1.0], 2),
     (3, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.01], 1), (None, [0.0, 2.0], 1), (None, [-1.0, 0.0], 1),
     (11, [1e-30, 0.0], 1), (12, [1e30, 0.0], 1), (13, [-0.0, 3.0], 1)],
], ids=["clusters", "far apart", "equal", "empty", "repeated ids and two lengths", "odd"])
def test_links_against_brute_force(spark, rows):
    found = linked_vectors(vectors(spark, rows).repartition(3), centres=8)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_many_blocks_find_the_same(spark, monkeypatch):
    import viaduct.llm.vector_dedup as module
    monkeypatch.setattr(module, "LEAST_BLOCK", 4)
    monkeypatch.setattr(module, "BLOCK_BYTES", 8 * 8 * 9)
    rows = as_rows(np.concatenate([drawn(60, 8, 6, .3), drawn(60, 8, 1, .2, seed=5)]))
    assert sorted(map(tuple, linked_vectors(vectors(spark, rows), centres=6).collect()), key=repr) == brute(rows)


def test_many_trees_a_block_find_the_same(spark, monkeypatch):
    import viaduct.llm.vector_dedup as module
    monkeypatch.setattr(module, "TREE", 7)
    monkeypatch.setattr(module, "LINKS_HELD", 3)
    monkeypatch.setattr(module, "BLOCK_BYTES", 8 * 8 * 40)
    monkeypatch.setattr(module, "LEAST_BLOCK", 40)
    rows = as_rows(np.concatenate([drawn(50, 8, 6, .3), drawn(40, 8, 1, .2, seed=5), drawn(30, 8, 30, 0, seed=6)]))
    assert sorted(map(tuple, linked_vectors(vectors(spark, rows), centres=6).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("kind, width", [("float", 4), ("double", 8)])
def test_vectors_travel_as_wide_as_their_column(spark, kind, width):
    frame = spark.createDataFrame([(1, [0.1, -0.0, 3.0]), (2, [0.1, 0.0, 3.0])], f"vec_id long, embedding array<{kind}>")
    rows = _keyed(frame, "vec_id", "embedding").collect()
    assert rows[0]["key"] == rows[1]["key"] and {len(row["vector"]) for row in rows} == {3 * width}


def test_components_of_a_double_column_are_not_rounded(spark):
    near = [(1, [1.0, 0.0]), (2, [1.0, 1e-12]), (3, [0.9, (1 - 0.81) ** 0.5 - 1e-9]), (4, [-1e-300, -1e300])]
    frame = spark.createDataFrame(near, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, linked_vectors(frame).collect())) == brute([(i, v, 0) for i, v in near])


def test_a_large_home_is_dealt_out_and_far_homes_do_not_meet():
    centres = {2: np.array([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]])}
    planned = plan([(2, 0, 5000, 0.1), (2, 1, 10, 0.1), (2, 2, 600, 0.1)], centres, 0.447, 1)
    blocks = {home: (base, n) for _, home, base, n in planned.homes}
    assert blocks[0][1] == 3 and blocks[1][1] == 1
    assert len({base for base, _ in blocks.values()}) == 2  # the two small homes share a block
    assert sorted(planned.meets) == sorted({(base, base, n) for base, n in blocks.values()})
    assert planned.pairs == 7
