"""Documents with the odd cases that every operator must give a defined result for."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Extra columns with names that operators use inside.
    *[T.StructField(name, T.StringType()) for name in
      ("id", "key", "n", "a", "b", "_hash", "_row", "_doc", "_again", "size", "target", "bucket", "score", "kept",
       "_seal", "seal", "row", "stays", "_digest", "toxic", "_order", "word", "_key", "_bin", "_ticket", "of", "form")],
])

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
BASE = " ".join(f"word{i}" for i in range(120))
NEAR = BASE.replace("word60", "other")
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog"), (2, "the QUICK brown fox jumps over the lazy dog"),
    (3, ""), (4, None), (5, " \t\n "), (6, BASE), (7, NEAR), (8, BASE + " tail"), (9, LONG), (10, LONG + " end"),
    (11, "x" * 50_000), (12, "a b c"), (13, "A b C"), (14, "ÄÖÜ é 漢字 🙂 ▁"), (15, "äöü é 漢字 🙂 ▁"),
    (16, "one one one one one one"), (17, "call +1 (202) 555-0143 or ann@example.com"),
    (None, "no id here, none at all"), (18, "same row twice"), (18, "same row twice"),
]


def documents(spark, texts=TEXTS):
    sources = ["s1", "s2", None, ""]
    extra = [None] * (len(SCHEMA) - 5)
    return spark.createDataFrame([(i, t, None, sources[k % 4], None, *extra) for k, (i, t) in enumerate(texts)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
    *[T.StructField(name, T.StringType()) for name in
      ("id", "x", "a", "b", "n", "own", "low", "code", "error", "of", "key", "block", "home", "unit", "weight", "node",
       "component", "links")],
])


def vectors(spark, rows):
    """Embeddings for rows of (vec_id, vector, label), with columns named as operators name theirs."""
    return spark.createDataFrame([(i, v, k, *[None] * (len(VECTORS) - 3)) for i, v, k in rows], VECTORS)
