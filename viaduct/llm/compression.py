"""Vector codes by codebooks of parts, with k-means rounds that rescan only where norm-of-sum bounds fail.

Each component x becomes the integer floor(256 * x). A vector is cut into PARTS equal consecutive parts; each part
position has a codebook of ENTRIES entries, which starts as that part of the rows with the smallest ids. A round
assigns every part to its nearest entry (squared Euclidean distance, ties to the lower index) and replaces each entry
by the componentwise floor(sum / count) of its parts; unused entries stay. After the last round parts are assigned
once more.

Bounds. The entries of a part are looked at in groups of GROUP. A row keeps, for every part and group, the least
distance to the group's entries when it was last scanned, and the stamp of that round. All codebooks since the start
are kept, so the bound is lowered by the true net displacement of the group's entries between that round and now, the
norm of the sum of their moves, and not by the sum of the moves' norms. The group of the part's own entry is always
scanned; another group is scanned only if its bound is not above the distance found there. Distances are integers, and
bounds are rounded down, so the result is the one of a full scan.

The codebooks and their history are PARTS * ENTRIES entries a round, whatever the table's size; tasks reduce their rows
to one sum per entry. Rows and bounds are stored in the shared folder between rounds.

Vectors that are null, empty, or hold a null or non-finite component are dropped. Ties of ids among the first rows are
broken by the components; null ids come last. With fewer rows than ENTRIES the codebook is shorter. Rows that repeat
an id are rows of their own. An empty table gives an empty result. All usable vectors must have one length, a multiple
of PARTS, and integers of at most 2**29, or ValueError is raised. Columns other than the three named are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shipping import ship
from .stored import forget, stored
from .vectors import usable, vector_of

PARTS, ENTRIES, ROUNDS, GROUP = 16, 64, 2, 8
SCALE = 256
MOST = 2 ** 29
STORED, SHIFT = np.dtype(">u4"), 2 ** 31
ROOM = 1 << 21  # numbers held at once while distances are taken


@dataclass(frozen=True)
class Codebooks:
    entries: np.ndarray  # part, entry, position; int64

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Integer vectors for rows of entry numbers."""
        return np.concatenate([book[codes[:, p]] for p, book in enumerate(self.entries)], axis=1)


@dataclass
class Bounds:
    """What a row keeps between rounds, for rows of a batch."""
    own: np.ndarray    # row, part: entry
    low: np.ndarray    # row, part, group: distance to the nearest entry of the group, rounded down
    stamp: np.ndarray  # row, part, group: round in which it was taken

    @classmethod
    def none(cls, rows: int, parts: int, groups: int) -> Bounds:
        return cls(np.zeros((rows, parts), np.uint8), np.full((rows, parts, groups), -np.inf, np.float32),
                   np.zeros((rows, parts, groups), np.uint8))


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """(round, part, group): the farthest that an entry of the group lies from where it was in that round."""
    moved = np.sqrt(((history[-1][None] - np.stack(history)) ** 2).sum(axis=-1).astype(np.float64))
    groups = range(0, moved.shape[2], GROUP)
    return np.stack([moved[:, :, g:g + GROUP].max(axis=2) for g in groups], axis=2)


def assign(x: np.ndarray, bounds: Bounds, history: list[np.ndarray]) -> tuple[Bounds, np.ndarray, int]:
    """New bounds, the squared distance of every part to its entry, and how many groups were scanned.

    `x` holds row, part, position; `history` the codebooks up to the one to assign to.
    """
    now, books = len(history) - 1, history[-1]
    rows, parts, _ = x.shape
    moved = displacements(history)
    own, low, stamp = bounds.own.copy(), bounds.low.copy(), bounds.stamp.copy()
    error = np.empty((rows, parts), np.int64)
    scanned = 0
    for part in range(parts):
        book = books[part]
        groups = range(-(-len(book) // GROUP))
        best = np.full(rows, np.iinfo(np.int64).max)
        entry = np.zeros(rows, np.int64)
        home = bounds.own[:, part].astype(np.int64) // GROUP

        def scan(wanted, group):
            nonlocal scanned
            scanned += len(wanted)
            first = group * GROUP
            far = ((x[wanted, part][:, None, :] - book[None, first:first + GROUP]) ** 2).sum(axis=2)
            near = far.argmin(axis=1)
            least = far[np.arange(len(wanted)), near]
            near += first
            better = (least < best[wanted]) | ((least == best[wanted]) & (near < entry[wanted]))
            best[wanted[better]], entry[wanted[better]] = least[better], near[better]
            low[wanted, part, group] = np.nextafter(np.sqrt(least.astype(np.float64)).astype(np.float32), np.float32(-1))
            stamp[wanted, part, group] = now

        for group in groups:
            scan(np.flatnonzero(home == group), group)
        for group in groups:
            since = low[:, part, group] - moved[stamp[:, part, group], part, group] * (1 + 1e-9)
            scan(np.flatnonzero((home != group) & (since <= np.sqrt(best.astype(np.float64)) * (1 + 1e-9))), group)
        own[:, part], error[:, part] = entry, best
    return Bounds(own, low, stamp), error, scanned


def _integers(frame: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(id, label, x) of the usable rows; x holds the integers, four bytes each, so that bytes sort as the integers do."""
    rows = frame.select(F.col(id).alias("id"), F.col(label).alias("label"), vector_of(vector).alias("vector"))
    kinds = rows.select("id", "label", F.lit(b"").alias("x")).schema

    def run(batches):
        for batch in batches:
            at, vectors = usable(batch.column("vector"))
            whole = []
            for one in vectors:
                scaled = np.floor(one * SCALE)
                if np.abs(scaled).max() > MOST:
                    raise ValueError(f"a component is beyond {MOST} / {SCALE}")
                whole.append((scaled + SHIFT).astype(STORED).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at)), batch.column("label").take(pa.array(at)),
                 pa.array(whole, pa.binary())], names=["id", "label", "x"])

    return rows.mapInArrow(run, kinds).transform(stored)


def _unpacked(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), STORED).astype(np.int64) - SHIFT


def _parts(column: pa.Array, parts: int) -> np.ndarray:
    return _unpacked(column.to_pylist()).reshape(len(column), parts, -1)


def _packed(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def _assigned(rows: DataFrame, history: list[np.ndarray], last: bool) -> DataFrame:
    """Per row what the next round needs, or in the last one its code and error."""
    parts, entries, width = history[-1].shape
    groups = -(-entries // GROUP)
    again = "own" in rows.columns
    if last:
        kinds = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    else:
        kinds = rows.select("id", "label", "x", *[F.lit(b"").alias(c) for c in ("own", "low", "stamp")]).schema
    step = max(1, ROOM // (GROUP * width))

    def unpacked(batch, name, kind, shape):
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, *shape)

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                x = _parts(batch.column("x"), parts)
                bounds = Bounds(unpacked(batch, "own", np.uint8, (parts,)),
                                unpacked(batch, "low", np.float32, (parts, groups)),
                                unpacked(batch, "stamp", np.uint8, (parts, groups))) if again else Bounds.none(
                                    batch.num_rows, parts, groups)
                found, error, _ = assign(x, bounds, history)
                named = [batch.column("id"), batch.column("label")]
                if last:
                    yield pa.RecordBatch.from_arrays(
                        [*named, pa.array([row.tobytes().hex() for row in found.own]),
                         pa.array(error.sum(axis=1))], names=["id", "label", "code", "error"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*named, batch.column("x"), _packed(found.own), _packed(found.low), _packed(found.stamp)],
                        names=["id", "label", "x", "own", "low", "stamp"])

    return rows.mapInArrow(run, kinds).transform(stored)


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after the parts' entries have been replaced by their means."""
    parts, entries, width = books.shape
    names = [f"s{k}" for k in range(width)]

    def run(batches):
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _parts(batch.column("x"), parts)
            own = np.frombuffer(b"".join(batch.column("own").to_pylist()), np.uint8).reshape(-1, parts)
            for part in range(parts):
                np.add.at(sums[part], own[:, part], x[:, part])
                counts[part] += np.bincount(own[:, part], minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
             *[pa.array(sums[part, entry, k]) for k in range(width)]], names=["part", "entry", "n", *names])

    partial = rows.select("x", "own").mapInArrow(run, ", ".join(["part int", "entry int", "n long",
                                                                 *[f"{n} long" for n in names]]))
    moved = books.copy()
    for row in partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ["n", *names]]).collect():
        moved[row["part"], row["entry"]] = [row[n] // row["n"] for n in names]
    return moved


def _first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    sizes = rows.agg(F.min(F.length("x")).alias("least"), F.max(F.length("x")).alias("most")).first()
    if sizes["least"] is None:
        return None
    if sizes["least"] != sizes["most"] or sizes["most"] // 4 % parts:
        raise ValueError(f"vectors of {sizes['least'] // 4} to {sizes['most'] // 4} components do not make {parts} equal parts")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    return _unpacked([row["x"] for row in first]).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()


def compress(frame: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Per usable row: id, label, code (entry numbers in part order, two hex digits each), error (squared distances
    summed over the parts); and the final codebooks. At most 256 entries."""
    ship(frame.sparkSession)
    rows = _integers(frame, id, vector, label)
    books = _first_books(rows, parts, entries)
    if books is None:
        return (rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")),
                Codebooks(np.zeros((parts, 0, 0), np.int64)))
    history = [books]
    for _ in range(rounds):
        assigned = _assigned(rows, history, last=False)
        forget(rows)
        rows = assigned
        history.append(_moved(rows, history[-1]))
    coded = _assigned(rows, history, last=True)
    forget(rows)
    return coded, Codebooks(history[-1])


def vector_codes(frame: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per usable row: the id, code, error, label_error (error summed over the rows with the same label, nulls
    together), codebooks_sha256 (of the final entries' integers by part, entry and position)."""
    coded, books = compress(frame, id, vector, label)
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")).transform(stored)
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id), "code", "error", "label_error",
                    F.lit(books.digest()).alias("codebooks_sha256")))
