import pytest

EDGE = [  # doc_id, text, lang, source, n_chars, and columns whose names clash with the operators' own
    (1, None, "en", "a", 0, 7, "x"), (2, "", None, "a", 0, 7, "x"), (3, " \n\t ", "en", None, 4, 7, "x"),
    (4, "one two three", "en", "a", 13, 7, "x"), (5, "one two three", "en", "b", 13, 7, "x"),
    (None, "lost document without an id but with words", "en", "a", 42, 7, None),
    (6, "it's they'll <|endoftext|> naïve 日本語  \n x", None, None, 30, 7, "x"),
    (7, " ".join(f"w{i}" for i in range(5000)), "en", "a", 1, 7, "x"),
    (7, " ".join(f"w{i}" for i in range(5000)), "en", "a", 1, 7, "x"),
    (8, " ".join(f"w{i}" for i in range(100, 400)), "de", "b", 1, 7, "x"),
    (9, "same " * 600, "de", "b", 1, 7, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies string"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
