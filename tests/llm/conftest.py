from pathlib import Path

import pytest

SF = Path("/root/testdata/sf0.001")
#: Names that operators use inside.
CLASHING = ("key", "t", "tag", "h", "gone", "fp", "n", "size", "start", "target", "taken", "score", "lang_pred",
            "digest", "bucket", "found", "wanted", "item_id", "pos", "head", "times", "copy", "mixed")


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
    return with_clashes(spark.createDataFrame(full, SCHEMA))


@pytest.fixture(scope="session")
def messy_rows():
    long = " ".join(f"word{i % 700} Of the" for i in range(40_000)) + "\n" + "\n".join(f"line {i}" for i in range(5000))
    return [
        (1, "the cat sat on the mat\nshared line here\nand slept", "en", "b"), (2, None, "en", "a"), (3, "", None, None),
        (4, "  \t\n \r ", "de", "a"), (5, long, "en", "a"), (6, "The  cat sat on\tthe mat\nshared line here\nand slept", "en", "b"),
        (7, "the cat sat on the mat\nshared line here\nand slept", None, None), (7, "the cat sat on the mat\nshared line here\nand slept", None, None),
        (None, "no id but text\nshared line here", "fr", "c"), (None, None, None, None), (8, "12345 67 !!", "en", "c"),
        (9, "straße ÉTÉ ﬁn 日本語 😀 <|endoftext|> x  <|endoftext|>", "de", "z"), (10, "word", "en", "b"), (11, "two words", "en", "b"),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    if not SF.exists():
        pytest.skip("tables not present")
    return spark.read.parquet(f"{SF}/documents.parquet")
