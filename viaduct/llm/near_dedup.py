"""Near-duplicate documents: SetSketch banding, a likelihood estimate, and verification on full sets.

A document's set holds its distinct runs of SHINGLE words after A-Z are lower-cased, or its whole word sequence if it
is shorter. Documents with 100 * |intersection| >= 80 * |union| are linked, and linked documents form components.

1. One pass hashes every whole text to its set, a sketch of the set (`setsketch`) and one key per band. Documents with
   the same set are one class from here on, so that copies are never compared.
2. Classes that share a band key are candidates. Buckets may be large, so pairs are not enumerated: a bucket is led by
   the class that meets most others, each class is estimated against the leaders of its buckets, and goes on with the
   best of them if the estimate is within SLACK_SDS standard deviations of the threshold. The full sets confirm the
   link. That joins large groups of near copies around their middle.
3. What is left are buckets whose classes are still in several components. Their full sets are compared, in blocks of
   BLOCK classes, until no two components of a block could be joined; only the links that join go on.

Only texts of candidates are read again for their full sets; a filter of fixed size (`bloom`) keeps all other texts out
of the shuffle. A pair at the threshold shares no band with probability (1 - 0.8**5)**30, which is 7 in a million; more
similar pairs are missed less often. There is no cap on buckets, partners or candidates, and every pair that shares a
band and is not joined through others is compared in full.

Null texts, empty texts and texts without words have no shingles, are linked with nothing and are kept. Documents
without an id are linked with nothing, have a null component and are kept. Rows that share an id and a text are one
document; other texts with the same id are documents of their own, linked, kept or dropped each by itself. A component
is named by the smallest id of its documents; `kept` tells the documents with that id, and where it has several texts
`drop_near_duplicates` lets one of them stay. An empty table gives an empty result. Columns other than doc_id and text
are not read by `near_duplicates`.
"""

from __future__ import annotations

import hashlib
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import setsketch
from .bloom import once_plane, passes
from .components import forest, tops, with_tops
from .merging import begin_task, give_back
from .shipping import ship
from .stored import stored
from .words import text_of

SHINGLE = 5
PERCENT = 80
SLACK_SDS = 5.0
BLOCK = 512


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """Ascending distinct shingle hashes. Only A-Z are lower-cased and only ASCII blanks separate words in bytes."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().lower().split()
    return setsketch.shingle_hashes(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)), shingle)


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def least_estimate(percent: int) -> float:
    j = percent / 100
    return j - SLACK_SDS * sqrt(j * (1 - j) / setsketch.REGISTERS)


def _seal() -> Column:
    """Tells texts that share an id from each other."""
    return F.xxhash64(text_of())


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """Per document: doc_id, seal (of the text), n_shingles, key (of the set), bands, registers."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"), _seal().alias("seal"))
    kinds = rows.select("doc_id", "seal", F.lit(0).cast("long").alias("n_shingles"), F.lit(b"").alias("key"),
                        F.lit(None).cast("array<bigint>").alias("bands"),
                        F.lit(None).cast("binary").alias("registers")).schema

    def run(batches):
        begin_task()
        for batch in batches:
            n, keys, bands, registers = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), shingle)
                n.append(len(hashes))
                keys.append(set_key(hashes))
                sketch = setsketch.registers(hashes) if len(hashes) else None
                bands.append(setsketch.band_keys(sketch) if len(hashes) else None)
                registers.append(sketch.tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "seal": batch.column("seal"), "n_shingles": pa.array(n, pa.int64()),
                "key": pa.array(keys, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64())),
                "registers": pa.array(registers, pa.binary())})
        give_back()

    return rows.mapInArrow(run, kinds)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) with the estimate of their similarity."""
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ra", "rb")
    kinds = joined.select("a", "b", F.lit(0.0).alias("estimate")).schema

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                first, second = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                                 .reshape(batch.num_rows, -1) for c in ("ra", "rb"))
                value = setsketch.estimate(first, second, *(batch.column(c).to_numpy() for c in ("na", "nb")))
                yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"),
                                                  "estimate": pa.array(value, pa.float64())})

    return joined.mapInArrow(run, kinds)


def _shingles_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of the classes with these ids. Other documents' texts do not reach the shuffle."""
    wanted = classes.select("id", "key", "doc_id", "seal").join(ids, "id").transform(stored)
    plane = docs.sparkSession.sparkContext.broadcast(
        once_plane(wanted.select(F.xxhash64("doc_id", "seal").alias("_hash")), wanted.count()))
    rows = (docs.select("doc_id", text_of().alias("text"), _seal().alias("seal"))
            .withColumn("_hash", F.xxhash64("doc_id", "seal")))

    def sift(batches):
        for batch in batches:
            keep = passes(plane.value, batch.column("_hash").to_numpy())
            yield batch.select(["doc_id", "text", "seal"]).filter(pa.array(keep, pa.bool_()))

    texts = rows.mapInArrow(sift, rows.drop("_hash").schema).join(wanted, ["doc_id", "seal"])
    kinds = texts.select("id", F.lit(b"").alias("shingles")).schema

    def run(batches):
        for batch in batches:
            ids, sets = [], []
            # One text at a time: a batch may be large.
            for i, key, text in zip(*(batch.column(c).to_pylist() for c in ("id", "key")), batch.column("text"), strict=True):
                hashes = shingle_set(text.as_py(), shingle)
                if set_key(hashes) == key:  # seals of unlike texts may be alike
                    ids.append(i)
                    sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(ids, batch.column("id").type), "shingles": pa.array(sets, pa.binary())})
        give_back()

    # Rows that repeat both id and text give the same set.
    return texts.select("id", "key", "text").mapInArrow(run, kinds).dropDuplicates(["id"]).transform(stored)


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _shingles_of(docs, classes, ids, shingle)
    joined = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
              .select("a", "b", "sa", "sb"))
    kinds = joined.select("a", "b").schema

    def run(batches):
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("sa"), batch.column("sb"), strict=True):
                first, second = (np.frombuffer(side.as_buffer(), np.uint64) for side in (one, two))
                common = len(np.intersect1d(first, second, assume_unique=True))
                keep.append(100 * common >= percent * (len(first) + len(second) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return joined.mapInArrow(run, kinds).transform(stored)


def _similar_size(first: str, second: str, percent: int):
    """Necessary for a link: the smaller set is at least that share of the larger."""
    return 100 * F.least(first, second) >= percent * F.greatest(first, second)


def _in_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of components with similar sets in a bucket, as many as it takes to join what belongs together.

    `members` holds (bucket, id, component), `sets` (id, shingles). Blocks of a large bucket meet pairwise in their own groups; a
    group has at most 2 * BLOCK rows on average, and a task holds one group at a time. Every set is compared in full
    with all sets of its group that are in another component by then, so that a group gives fewer links than rows.
    """
    # Read back, so that the join deals out both sides itself and can split the members of a large bucket.
    sizes = (members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
             .transform(stored))
    placed = (members.join(sizes, "bucket")
              .withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    placed = placed.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                           "mine", "id", "component")
    # The sets, which are large, join last and are dealt out once.
    dealt = placed.join(sets, "id").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    named = members.schema["component"].dataType
    kinds = T.StructType([T.StructField("a", named), T.StructField("b", named)])

    def run(batches):
        begin_task()
        held, current = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if held and (keys[start] != current).any():
                    yield from _joining_links(pa.Table.from_batches(held), percent)
                    held = []
                current = keys[start]
                held.append(batch.slice(start, end - start))
        if held:
            yield from _joining_links(pa.Table.from_batches(held), percent)
        held = []
        give_back()

    return dealt.mapInArrow(run, kinds).distinct()


def _joining_links(group: pa.Table, percent: int):
    """The links between components that one group gives, in an Arrow batch (a, b)."""
    names = group.column("component").combine_chunks()
    component = np.unique(np.array(group.column("component").to_pylist()), return_inverse=True)[1]
    if component.max() == 0:
        return
    sets = [np.frombuffer(one.as_buffer(), np.uint64) for one in group.column("shingles")]
    size = np.array([len(one) for one in sets])
    place = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    # Within one block all pairs are met; of two blocks only pairs across, as each block also meets itself.
    first, second = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    mine = group.column("mine").to_numpy()
    rows = range(len(size)) if first == second else np.flatnonzero(mine == first)
    marked = np.zeros(place.max() + 1, np.int32)
    found = []
    for row in rows:
        across = component != component[row]
        if first != second:
            across &= mine == second
        if not across.any():
            continue
        own = place[starts[row]:starts[row] + size[row]]
        marked[own] = 1
        common = np.add.reduceat(marked[place], starts)
        marked[own] = 0
        linked = across & (100 * common >= percent * (size + size[row] - common))
        for other in np.flatnonzero(linked):
            if component[other] != component[row]:
                found.append((row, other))
                component[component == component[other]] = component[row]
    if found:
        a, b = (names.take(pa.array(np.array(side, np.int64))) for side in zip(*found, strict=True))
        yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def _links(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, component) of every class that is linked with another."""
    keyed = classes.select(F.explode("bands").alias("bucket"), "id", "n")
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").transform(stored)
    crowded = keyed.join(sizes, "bucket").transform(stored)
    # A bucket is led by the class that meets most others over all its buckets: the middle of a group of near copies.
    met = crowded.groupBy("id").agg(F.sum("size").alias("met")).transform(stored)
    leaders = (crowded.join(met, "id").groupBy("bucket").agg(F.max(F.struct("met", "id", "n")).alias("first"))
               .select("bucket", F.col("first.id").alias("b"), F.col("first.n").alias("nb")).transform(stored))
    led = (crowded.join(leaders, "bucket").filter((F.col("id") != F.col("b")) & _similar_size("n", "nb", percent))
           .select(F.col("id").alias("a"), "b").distinct())
    led = _estimated(led, classes).filter(F.col("estimate") >= least_estimate(percent))
    led = led.groupBy("a").agg(F.max_by("b", "estimate").alias("b")).transform(stored)
    links = _confirmed(led, docs, classes, shingle, percent)
    # A leader has met more than those it leads, or as many and has the larger id, so that these links are a forest.
    labels = tops(links.select(F.col("a").alias("node"), F.col("b").alias("parent")))

    known = labels.select(F.col("node").alias("id"), "component")
    members = (crowded.select("bucket", "id").join(known, "id", "left")
               .select("bucket", "id", F.coalesce("component", "id").alias("component")).transform(stored))
    # Similar classes share many bands: of buckets with the same members one is enough. Their number and two sums of
    # hashes, 128 bits, stand for the members.
    split = (members.groupBy("bucket").agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"),
                *[F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(20,0)")).alias(f"sum{k}") for k in (1, 2)])
             .filter("low <> high").groupBy("size", "sum1", "sum2").agg(F.min("bucket").alias("bucket"))
             .select("bucket").transform(stored))
    members = members.join(split, "bucket").transform(stored)
    if members.isEmpty():
        return with_tops(labels)
    sets = _shingles_of(docs, classes, members.select("id").distinct(), shingle)
    more = _in_blocks(members, sets, percent).transform(stored)
    if more.isEmpty():
        return with_tops(labels)
    # The tops of the first forest hook on to each other, which makes one forest of both.
    return with_tops(tops(labels.withColumnRenamed("component", "parent").unionByName(forest(more))))


def _judged(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rows of `near_duplicates`, with the seals of their texts and `stays`: kept, but for one text of each id only."""
    sketched = sketches(docs, shingle).transform(stored)
    linkable = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # A class has a number of its own, as an id may have several texts; it holds for the stored table.
    classes = (linkable.groupBy("key")
               .agg(F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "bands", "registers", "seal")).alias("c"))
               .select("key", F.monotonically_increasing_id().alias("id"), "c.*").transform(stored))
    labels = _links(docs, classes, shingle, percent).withColumnRenamed("node", "id")
    linked = classes.select("id", "key", "doc_id").join(labels, "id").transform(stored)
    first = linked.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("first")).transform(stored)
    known = (linked.join(first, "component")
             .select("key", F.col("first.doc_id").alias("component_id"), (F.col("key") == F.col("first.key")).alias("leads")))
    known = (classes.select("key", "doc_id").join(known, "key", "left")
             .select("key", F.coalesce("component_id", "doc_id").alias("component_id"),
                     F.coalesce("leads", F.lit(True)).alias("leads")).transform(stored))
    rows = sketched.select("doc_id", "seal", "n_shingles",
                           F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    found = rows.join(known, "key", "left")
    component = F.coalesce("component_id", "doc_id")
    kept = F.col("doc_id") == component
    return found.select("doc_id", "seal", "n_shingles", component.alias("component_id"),
                        F.coalesce(kept, F.lit(True)).alias("kept"),
                        F.coalesce(kept & F.col("leads"), F.lit(True)).alias("stays"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id that can be reached), kept."""
    return _judged(docs, shingle, percent).drop("seal", "stays")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one of each component, with all their columns."""
    gone = _judged(docs, shingle, percent).filter("NOT stays").select("doc_id", "seal").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", _seal().alias("seal"))
    return rows.join(gone, ["doc_id", "seal"], "left_anti").select("row.*")
