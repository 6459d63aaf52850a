"""Quality rules: a table of thresholds, compiled into one projection of built-in expressions.

A rule is (name, measure, least, most); either bound may be None. `judge_quality` turns the table into columns: the
measures, the names of the rules that failed, and `kept`. No user function, shuffle or explode is involved; a text
is split into words and lines once.

Texts shorter than a rule's measure needs count as 0 for ratios over words or lines. A null text counts as empty: it
has no words, fails `words`, and is dropped. Repeated rows are judged alike; an empty table gives an empty result.
Columns other than doc_id and text are not read by `judge_quality`, and are kept by `keep_good`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .words import BLANKS, text_of, word_list

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, Spanish and French.
STOP_WORDS = tuple((
    "the of and to in a is that for it with as was be by on are from this at or an "
    "der die das und in zu den von mit ist nicht ein eine sich auf für im dem des als "
    "el la los las de y en que un una por con para es se no al del lo su "
    "le les et des du est une dans qui sur au pour pas par avec ce il elle à").split())
NEAR = 3  # words of a window that may repeat

#: (name, measure, least, most)
THRESHOLDS = (
    ("words", "n_words", 50, 100_000),
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbols_per_word", None, 0.1),
    ("marks", "marks_per_word", None, 0.4),
    ("stop_words", "n_stop_words", 2, None),
    ("stop_share", "stop_words_per_word", 0.02, None),
    ("repeated_words", "repeat_words_share", None, 0.5),
    ("repeated_lines", "dup_lines_share", None, 0.7),
    ("cut_lines", "cut_lines_share", None, 0.3),
    ("listed_lines", "listed_lines_share", None, 0.9),
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of NEAR words which the text holds twice or more.

    Windows are sorted with their places, so that equal ones are neighbours; those with an equal neighbour are put
    back in order and the words that they cover are added up. Texts in which all windows differ skip the sorting.
    """
    places = F.sequence(F.lit(1), F.size(words) - (NEAR - 1))
    windows = F.transform(places, lambda i: F.concat_ws(" ", *[F.element_at(words, i + k) for k in range(NEAR)]))

    def covered(windows: Column) -> Column:
        ranked = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.transform(F.array(ranked), lambda s: _span(F.array_sort(F.transform(
            F.filter(F.transform(s, lambda x, i: F.struct(
                x["i"].alias("i"),
                ((x["w"] == F.get(s, i - 1)["w"]) | (x["w"] == F.get(s, i + 1)["w"])).alias("twice"))),
                lambda x: F.coalesce(x["twice"], F.lit(False))), lambda x: x["i"]))))[0]

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered(windows))

    one = F.transform(F.array(windows), counted)[0]
    return F.when(F.size(words) < NEAR + 1, F.lit(0)).otherwise(one).cast("long")


def _span(starts: Column) -> Column:
    """Places covered by windows of NEAR words that start at these places, in order."""
    return F.aggregate(starts, F.struct(F.lit(-NEAR).alias("end"), F.lit(0).alias("sum")), lambda a, i: F.struct(
        i.alias("end"), (a["sum"] + F.least(F.lit(NEAR), i - a["end"])).alias("sum")), lambda a: a["sum"])


def counts(text: Column) -> list[Column]:
    """What the rules count in a text, over an array `words` and `lines` (see `with_counts`)."""
    worded = F.filter(F.col("_lines"), lambda line: F.length(F.regexp_replace(line, BLANKS, "")) > 0)
    return [
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "!?…", ""))).cast("long").alias("n_marks"),
        F.size(worded).cast("long").alias("n_lines"),
        (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(worded, lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_cut_lines"),
        F.size(F.filter(worded, lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("n_listed_lines"),
        F.size(F.array_intersect("_words", _listed())).alias("n_stop_words"),
        F.size(F.filter("_words", lambda word: word.isin(*STOP_FORMS))).alias("n_stop_places"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
    ]


STOP_FORMS = tuple(sorted({form for word in STOP_WORDS for form in (word, word.capitalize())}))


def _listed() -> Column:
    return F.array(*[F.lit(word) for word in STOP_FORMS])


def with_counts(docs: DataFrame) -> DataFrame:
    text = text_of()
    split = docs.select("doc_id", text.alias("_text"), word_list(text).alias("_words"),
                        F.split(text, "\n").alias("_lines"))
    return split.select("doc_id", *counts(F.col("_text")))


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


MEASURES = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_chars": lambda: _share("word_chars", "n_words"),
    "symbols_per_word": lambda: _share("n_symbols", "n_words"),
    "marks_per_word": lambda: _share("n_marks", "n_words"),
    "n_stop_words": lambda: F.col("n_stop_words"),
    "stop_words_per_word": lambda: _share("n_stop_places", "n_words"),
    "repeat_words_share": lambda: _share("n_repeat_words", "n_words"),
    "dup_lines_share": lambda: _share("n_dup_lines", "n_lines"),
    "cut_lines_share": lambda: _share("n_cut_lines", "n_lines"),
    "listed_lines_share": lambda: _share("n_listed_lines", "n_lines"),
}


def compiled(thresholds=THRESHOLDS) -> Column:
    """The names of the failed rules, comma-joined, as one expression over the counts."""
    failed = []
    for name, measure, least, most in thresholds:
        value = MEASURES[measure]()
        below = value < least if least is not None else F.lit(False)
        above = value > most if most is not None else F.lit(False)
        failed.append(F.when(below | above, F.lit(name)))
    return F.concat_ws(",", *failed)


def judge_quality(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Per document: doc_id, the counts, `failed` (names of the rules it fails) and `kept`."""
    return (with_counts(docs).withColumn("failed", compiled(thresholds))
            .withColumn("kept", F.col("failed") == ""))


def keep_good(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents that fail no rule, with all their columns, without a join."""
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("_row"), text_of().alias("_text"), word_list(text_of()).alias("_words"),
                         F.split(text_of(), "\n").alias("_lines"))
    counted = packed.select("_row", *counts(F.col("_text")))
    return counted.filter(compiled(thresholds) == "").select("_row.*")
