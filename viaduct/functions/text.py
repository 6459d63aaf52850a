"""Road names and the ids made from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Names that need no tidying but capitals: plain letters with single spaces between words.
TIDY = r"^[A-Za-z]++(?: [A-Za-z]++)*+$"
# What counts as blank between words, control separators included.
BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
# Where a letter that has case follows something else than a blank or another such letter.
_CASED = r"[\p{IsLowercase}\p{IsUppercase}\p{Lt}]"
INNER_WORD = rf"(?<=[^ ])(?<!{_CASED})(?={_CASED})"
# A code point that Unicode reserves for use inside programs; it marks a break to be taken out again.
MARK = "\ufdd0"


def normalize_road_name(name: Column) -> Column:
    """Trim, collapse blanks, capitalise each run of letters; null becomes ''.

    A plain `initcap` breaks at blanks only and would leave "o'neil 6th-st" as "O'neil 6th-st", so a
    marked blank goes before every run of letters inside a word, and comes out after. Most names are
    tidy already and skip that, which halves the cost. A marker in the name itself is left out first.
    """
    plain = F.replace(F.coalesce(name, F.lit("")), F.lit(MARK), F.lit(""))
    words = F.trim(F.regexp_replace(plain, BLANKS, " "))
    broken = F.regexp_replace(words, INNER_WORD, f"{MARK} ")
    return F.when(name.rlike(TIDY), F.initcap(name)).otherwise(
        F.replace(F.initcap(broken), F.lit(f"{MARK} "), F.lit("")))


def sensor_id_for_road(road_name: Column) -> Column:
    """The id of a road's first sensor, for readings that carry only the road name."""
    return F.concat(F.lit("SENSOR_"), F.upper(F.replace(road_name, F.lit(" "), F.lit("_"))), F.lit("_01"))
