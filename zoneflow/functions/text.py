"""Text expressions: whitespace, number words, integers, tokens, paths, word statistics.

Every function takes a Column (or column name) and returns a Column built from Spark
built-ins. Patterns use ``\\x{..}`` escapes, which Java and RE2 read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that separate words.
SPACE_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# English number words.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6,
    "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12,
    "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17,
    "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40,
    "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90,
    "hundred": 100, "thousand": 1000, "million": 1000000, "billion": 1000000000,
}
HAS_NUMBER_WORD = rf"(?i)\b({'|'.join(NUMBER_WORDS)})\b"

# Number, zone-code and district-code shapes.
SPACED_INTEGER = r"\s[0-9]+\s"
BRACKETED_INTEGER = r"\([0-9]+\)"
ZONE_CODE = r"[A-Z]+\d-*\d*[A-Z]*"
DISTRICT_CODE = r"[A-Z]-\d[A-Z]?"
PUNCTUATION = r"[^\p{L}\p{N}_ ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_pattern(pattern: str) -> str:
    """Give a rule written for one-line text its usual meaning in Java.

    ``d``: only a line feed stops ``.``, so a stray carriage return does not end a match.
    ``u``: ``(?i)`` folds all letters, not just ASCII.
    """
    if pattern.startswith("(?i)"):
        return "(?iud)" + pattern[4:]
    return "(?d)" + pattern


def required_letters(pattern: str) -> list[str]:
    """Runs of lower-case letters that every match of a simple ``(?i)`` pattern holds; none for other patterns."""
    body = pattern[4:]
    if not pattern.startswith("(?i)") or re.search(r"[^A-Za-z.+*?()|]", body) or "(?" in body:
        return []
    body = re.sub(r"\([^()]*\)[*+?]*", ".", body)  # a group may be left out or hold a choice
    if re.search(r"[()|]", body):
        return []
    body = re.sub(r"[A-Za-z.][*?]", ".", body)
    return sorted({run.lower() for run in re.findall("[A-Za-z]+", body)}, key=lambda x: (-len(x), x))


def plain_lower(c: Column | str) -> Column:
    """A text of ASCII characters in lower case; null for others, which may fold to ASCII letters."""
    c = _col(c)
    return F.when(F.octet_length(c) == F.length(c), F.lower(c))


def plain_spaces(c: Column | str) -> Column:
    return F.translate(_col(c), "\u00a0", " ")


def flat_spaces(c: Column | str) -> Column:
    """Every kind of white space as a plain space. A translation per character is several
    times cheaper than a regex class of this many ranges."""
    return F.translate(_col(c), SPACE_CHARS, " " * len(SPACE_CHARS))


def collapse_spaces(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(flat_spaces(c), "  +", " "))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(flat_spaces(c), F.lit("[^ ]+"))


def has_number(c: Column | str) -> Column:
    """Cheap test that runs ahead of number extraction."""
    c = _col(c)
    return c.rlike("[0-9]") | c.rlike(HAS_NUMBER_WORD)


def _number_token(token: Column) -> Column:
    """Value of a number word or a hyphenated run of them, else NULL."""
    values = F.create_map(*[F.lit(x).cast("bigint") if isinstance(x, int) else F.lit(x)
                            for pair in NUMBER_WORDS.items() for x in pair])
    zero = F.lit(0).cast("bigint")
    parts = F.array_compact(
        F.transform(F.split(F.lower(token), "-"), lambda p: F.element_at(values, p))
    )

    def add(acc: Column, v: Column) -> Column:
        run = F.greatest(acc["run"], F.lit(1).cast("bigint"))
        return (
            F.when(v >= 1000, F.struct((acc["total"] + run * v).alias("total"), zero.alias("run")))
            .when(v == 100, F.struct(acc["total"].alias("total"), (run * v).alias("run")))
            .otherwise(F.struct(acc["total"].alias("total"), (acc["run"] + v).alias("run")))
        )

    total = F.aggregate(
        parts,
        F.struct(zero.alias("total"), zero.alias("run")),
        add,
        lambda acc: acc["total"] + acc["run"],
    )
    return F.when(F.size(parts) > 0, total.cast("string"))


def digits_for_words(c: Column | str) -> Column:
    """Collapse whitespace and write number words as digits, one token at a time."""
    c = _col(c)
    flat = collapse_spaces(c)
    return F.when(
        c.rlike(HAS_NUMBER_WORD),
        F.array_join(
            F.transform(F.split(flat, " "), lambda t: F.coalesce(_number_token(t), t)), " "
        ),
    ).otherwise(flat)


def without_commas(c: Column | str) -> Column:
    return F.translate(_col(c), ",", "")


def integers(c: Column | str) -> Column:
    """Integers standing alone between spaces, or in brackets, as doubles.

    Expects the output of ``without_commas(digits_for_words(line))``. A match takes its
    spaces with it, so of three adjacent integers the middle one is not found; integers at
    either end of the line and decimals are not found either.
    """
    c = _col(c)
    found = F.concat(
        F.regexp_extract_all(c, F.lit(SPACED_INTEGER), F.lit(0)),
        F.regexp_extract_all(c, F.lit(BRACKETED_INTEGER), F.lit(0)),
    )
    return F.transform(found, lambda x: F.regexp_replace(x, "[() ]", "").cast("double"))


def between_open(values: Column | str, low: Column, high: Column) -> Column:
    """Distinct ascending values strictly inside (low, high)."""
    inside = F.filter(_col(values), lambda v: (v > low) & (v < high))
    return F.array_sort(F.array_distinct(inside))


def float_text(c: Column | str) -> Column:
    """Shortest decimal text of a double: plain digits up to 1e16, exponent beyond.

    Spark switches to an exponent at 1e7 and below 1e-3; logs need ``12345678.0`` and
    ``0.0005``.
    """
    c = _col(c).cast("double")
    raw = c.cast("string")
    size = F.abs(c)

    def plain(scale: int) -> Column:
        return F.regexp_replace(c.cast(f"decimal(38,{scale})").cast("string"), r"(\.[0-9]+?)0+$", "$1")

    power = F.regexp_replace(F.regexp_replace(raw, r"\.0E", "E"), "E([0-9])", "e+$1")
    power = F.regexp_replace(F.regexp_replace(power, "E-([0-9])$", "e-0$1"), "E-", "e-")
    return (
        F.when(~raw.contains("E"), raw)
        .when((size >= 1e7) & (size < 1e16), plain(10))
        .when((size >= 1e-4) & (size < 1e-3), plain(25))
        .otherwise(power)
    )


def float_list_text(values: Column | str) -> Column:
    return F.array_join(F.transform(_col(values), float_text), ", ")


def codes(c: Column | str, pattern: str) -> Column:
    """All matches of a code pattern in a line, in order of appearance."""
    return F.regexp_extract_all(_col(c), F.lit(line_pattern(pattern)), F.lit(0))


# --- paths: root/city/MM-DD-YY/title.txt -------------------------------------------------

def path_part(path: Column | str, index: int) -> Column:
    return F.get(F.split(_col(path), "/"), F.lit(index))


def path_section(path: Column | str) -> Column:
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.split(name, r"\.")[0]


def full_year(year: Column) -> Column:
    """Two-digit year text with its century; 69-99 belong to the 1900s."""
    return F.when(F.length(year) == 2, F.concat(F.when(year >= "69", "19").otherwise("20"), year))


def short_date(text: Column | str) -> Column:
    """Date from month-day-two-digit-year; other text gives NULL."""
    text = _col(text)
    dated = F.concat_ws("-", F.substring_index(text, "-", 2), full_year(F.substring_index(text, "-", -1)))
    return F.try_to_timestamp(dated, F.lit("M-d-yyyy")).cast("date")


def path_tokens(path: Column | str) -> Column:
    """Lower-case words of a path; a title or chapter keeps its number as one token."""
    flat = F.regexp_replace(_col(path), "[/.,!?;]", " ")
    joined = F.regexp_replace(flat, "([Tt]itle|[Cc]hapter) ([0-9A-Z]+)", "$1-$2")
    spaced = F.regexp_replace(joined, r"""([\[\](){}<>:"&@#$%*])""", " $1 ")
    return F.split(collapse_spaces(F.lower(spaced)), " ")


# --- word statistics ----------------------------------------------------------------------

def strip_punctuation(c: Column | str) -> Column:
    return F.regexp_replace(flat_spaces(c), PUNCTUATION, "")


def words(c: Column | str, stop_words: list[str] | None = None) -> Column:
    """Words of a line without punctuation and stop words."""
    found = F.split(strip_punctuation(c), " +")
    if stop_words:
        found = F.filter(found, lambda w: (w != "") & ~F.lower(w).isin(stop_words))
    else:
        found = F.filter(found, lambda w: w != "")
    return found
