import pytest

SF = "/root/testdata/sf0.001"

#: Nulls, empty and blank texts, repeated ids and rows, unusual white space and letters, and column names that operators use inside.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a", 1, 0.5),
    (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a", 1, 0.5),
    (2, "the quick  brown fox\n jumps over the lazy\t dog \x0b end\x1c x   y", "en", "a", 2, None),
    (3, None, "en", None, None, 0.1),
    (4, "", None, "b", 0, 0.1),
    (5, "   \n\t ", "en", "b", 6, 0.1),
    (None, "no id at all, twice", "de", "c", 3, 0.3),
    (None, "no id at all, twice", "de", "c", 3, 0.3),
    (6, "Äpfel ÜBER straße '' it's don't <|endoftext|> 123 4567!!! \U0001f600\U0001f600", "de", None, 9, 0.2),
    (7, "x", "en", "c", 1, 0.0),
    (8, "word " * 60_000 + "end", "en", "d", 300_003, 0.0),
    (9, "Y" * 200_000, "en", "d", 200_000, 0.0),
    (6, "another text under an id that repeats", "de", "a", 9, 0.2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns named like the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("fp", "found", "taken", "size", "n_words", "held_out", "pattern", "_kiln_fp", "_kiln_found", "_kiln_mix", "_kiln_copy",
                 "_kiln_file", "_kiln_row", "_metadata", "_KILN_AT", "at", "place", "times", "fp_", "rank", "piece"):
        df = df.withColumn(name, F.lit("theirs"))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


def bag(rows):
    """Rows as a multiset."""
    return sorted(map(repr, rows))
