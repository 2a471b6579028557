import os

import pytest

ROOT = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))

# Nulls in any column, empty and very long texts, ties, repeated rows, columns of clashing names.
ODD_DOCUMENTS = [
    (1, None, "en", "a", 5),
    (2, "", None, "a", None),
    (3, "   \n\n ", "en", None, 3),
    (4, LONG, "en", "b", 1),
    (4, LONG, "en", "b", 1),
    (5, " ".join(WORDS * 2), "en", "c", 1),
    (6, " ".join(WORDS * 2), "en", "d", 1),
    (6, "another text under the same id", "en", "d", 1),
    (7, "Under the MIT License. under\tthe mit license", "en", "a", 1),
    (8, "été ☃ naïve word <|endoftext|> x\x0by \x1c z", "fr", "a", 1),
    (9, "one", "en", "a", 1),
    (None, "a text of no id", "en", "a", 1),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, id_ string, chunk string, "
    "number string, text_ string, words string, node string, component string, row_ string"
)


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, "s", "i", "c", "n", "t", "w", "o", "p", "r") for r in ODD_DOCUMENTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(ROOT):
        pytest.skip("needs the generated tables")
    return spark.read.parquet(f"{ROOT}/documents.parquet")


@pytest.fixture(scope="session")
def root():
    if not os.path.isdir(ROOT):
        pytest.skip("needs the generated tables")
    return ROOT


def table_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
