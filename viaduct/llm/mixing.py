"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Each source is due a share of the total by weight, but is read at most `max_epochs` times. Sources whose share
would be larger are clamped there, and what they leave is shared among the others by weight until none is above its
cap. A document is then repeated as often as its source needs in whole; the rest of the target, less than one reading
of the source, is taken in the order of a seeded ticket, so that it is a random sample of the documents. The last of
these is taken in part, which lets every source meet its target to the word.

Nothing is gathered by source: sizes are summed before the shuffle, tickets are put into `16 ** TICKET_DIGITS` bins
by their first digits, and the running totals need one small window over bins and one within each bin, so that a
source with a third of all rows is spread over all bins.

Null texts and empty texts have size 0 and are taken with 0 words. A null source is a source of its own, last in
order. Sources without words have target 0. Rows that repeat a doc_id are rows of their own. An empty table gives an
empty result. Columns other than doc_id, text and source are not read by `plan_mix`.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window, functions as F

from .words import BLANKS, text_of, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
TICKET_DIGITS = 3


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`target` for each row of (source, source_size): one row per source.

    In order of cap by weight, the sources to clamp come first: one is clamped if its share of what the sources
    before it left is above its cap. All comparisons are of whole numbers.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place + 1).cast("int"))
    step = lcm(*weights)
    by_cap = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    before, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()

    def left(name: str) -> Column:
        return F.sum(name).over(everything) - F.coalesce(F.sum(name).over(before), F.lit(0))

    capped = (sizes.withColumn("_weight", weight)
              .withColumn("_cap", F.col("source_size") * max_epochs)
              .withColumn("_fill", F.col("_cap") * F.expr(f"{step} div _weight")))
    capped = (capped.withColumn("_words_left", F.sum("source_size").over(everything)
                                - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
              .withColumn("_weight_left", left("_weight")))
    clamped = F.col("_cap") * F.col("_weight_left") < F.col("_weight") * F.col("_words_left")
    marked = capped.withColumn("_clamped", clamped)

    def free(name: str) -> Column:
        return F.coalesce(F.sum(F.when(~F.col("_clamped"), F.col(name))).over(everything), F.lit(0))

    spare = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("_clamped"), F.col("_cap"))).over(everything), F.lit(0))
    share = (F.col("_weight") * spare).cast("double") / free("_weight").cast("double")
    return marked.select("source", "source_size",
                         F.when(F.col("_clamped"), F.col("_cap").cast("double")).otherwise(share).alias("target"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, repeats (whole readings), extra (words of the part that is
    read once more) and taken (words, repeats counted)."""
    sized = _sized(docs).checkpoint()
    return _placed(sized, sized, weights, max_epochs, seed)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The mixed documents with the columns they came with: each row as often as its source is read in whole, once
    more if the sample holds it, and of the document taken in part the beginning as it stands, up to the last word
    taken. Rows from which no words are taken are left out, and so are texts without words."""
    names = docs.columns
    rows = _sized(docs, F.struct(*names).alias("_row"))
    placed = _placed(rows, _sized(docs).checkpoint(), weights, max_epochs, seed).filter("taken > 0")
    cut = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    copies = (F.col("repeats") + F.when(F.col("extra") > 0, 1).otherwise(0)).cast("int")
    copied = placed.select("_row", "extra", cut.alias("_cut"), "repeats",
                           F.explode(F.sequence(F.lit(1), copies)).alias("_copy"))
    text = F.when(F.col("_cut") & (F.col("_copy") > F.col("repeats")), _beginning(text_of("_row.text"), F.col("extra"))).otherwise(F.col("_row.text"))
    return copied.select(*[text.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in names])


def _beginning(text: Column, words: Column) -> Column:
    """The text up to the end of that many words, fewer than it has."""
    leading = F.when(text.rlike("^" + BLANKS), 1).otherwise(0)  # the split begins with an empty part
    rest = F.element_at(F.split(text, BLANKS, (words + 1 + leading).cast("int")), -1)
    return F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(rest)), F.lit(" \t\n\x0b\f\r"))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       word_count(text_of()).alias("size"), *more)


def _placed(rows: DataFrame, sized: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: str) -> DataFrame:
    """`rows` with what is taken of each; `sized` holds the same documents without their texts."""
    sources = water_fill(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = (sources.withColumn("repeats", whole.cast("long"))
               .withColumn("_part", F.floor(F.col("target") - F.col("repeats") * F.col("source_size") + 0.5))
               .select(_key().alias("_key"), "source_size", "target", "repeats", "_part"))

    def dealt(frame: DataFrame) -> DataFrame:
        ticket = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                       .cast("binary"))
        return (frame.withColumn("_key", _key()).withColumn("_ticket", ticket)
                .withColumn("_bin", F.substring("_ticket", 1, TICKET_DIGITS)).drop("source"))

    bins = dealt(sized).groupBy("_key", "_bin").agg(F.sum("size").alias("_in_bin"))
    earlier = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (bins.withColumn("_offset", F.coalesce(F.sum("_in_bin").over(earlier), F.lit(0)))
               .drop("_in_bin").join(sources, "_key"))
    ties = [F.col("_row").getField("text")] if "_row" in rows.columns else []
    within = (Window.partitionBy("_key", "_bin").orderBy("_ticket", "doc_id", "size", *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (dealt(rows).withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(offsets, ["_key", "_bin"]))
    room = F.col("_part") - F.col("_offset") - F.col("_inside")
    return (placed.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long"))
            .withColumn("taken", F.col("repeats") * F.col("size") + F.col("extra"))
            .drop("_key", "_bin", "_ticket", "_inside", "_offset", "_part"))


def _key() -> Column:
    """The source as a key that is never null, so that null joins with null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
