import random

import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

#: Extra columns whose names the operators might use themselves.
CLASHES = ("id", "t", "k", "digest", "counts", "t_", "w_", "score", "rejected", "lang_pred", "rate", "copy", "key",
           "removed", "n_units", "elsewhere", "n_words", "passes", "failed_rules", "copies", "p", "bands", "class_id")

PROSE = ("the old river ran past the mill and the miller watched it for hours while his dog slept in the shade "
         "of the wall because it was a warm day and nobody came to the door").split()


def prose(seed: int, n: int) -> str:
    """``n`` made-up words in sentences and lines."""
    rng = random.Random(seed)
    words = []
    for i in range(n):
        w = rng.choice(PROSE) if rng.random() < 0.4 else "".join(rng.choice("bdfglmnprstvaeiou") for _ in range(rng.randint(3, 9)))
        words.append(w.capitalize() if i % 9 == 0 else w + "." if i % 9 == 8 else w)
    return "\n".join(" ".join(words[i:i + 36]) for i in range(0, n, 36))


def awkward_rows() -> list[tuple]:
    long = prose(5, 60_000)
    same = prose(6, 120)
    return [
        (1, same, "en", "a", len(same)), (1, same, "en", "a", len(same)), (2, same, "en", "a", len(same)),
        (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \t\n ", "en", None, 4),
        (6, long, "en", "a", len(long)), (None, prose(7, 80), "en", "a", 1), (None, None, None, None, None),
        (8, "one two", "de", "b", 7), (9, "!!! ### 123", "de", "b", 11), (10, prose(8, 200), None, "b", 0),
        (11, "<|endoftext|> ’\x1c\x85 \U0001f600 ß漢字", "fr", "c", 0), (12, prose(9, 90), "fr", "c", 0),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows and ids, and extra columns with clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(awkward_rows(), COLUMNS)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def empty(spark):
    from pyspark.sql import functions as F
    return spark.createDataFrame([], COLUMNS).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
