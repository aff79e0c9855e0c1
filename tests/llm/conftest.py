import pytest

# Columns whose names the operators use inside.
EXTRA = "id string, key long, hash string, size long, component long, n long, range string, words string, its_row long, part long"
DOCUMENTS = f"doc_id long, text string, lang string, source string, {EXTRA}"


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, "x", 1, "h", 7, 3, 2, "r", "w", 9, 4)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and a repeated id with other text."""
    long = prose(1, 30_000)
    return [
        document(1, None),
        document(2, ""),
        document(3, " \t\n"),
        document(4, "one"),
        document(5, "One"),
        document(6, long),
        document(7, long + " end"),
        document(8, prose(2, 60)),
        document(8, prose(2, 60)),
        document(9, prose(3, 60)),
        document(9, prose(2, 60)),
        document(None, prose(4, 50)),
        document(10, prose(5, 80), None, None),
        document(11, "é ß 日本 ½ ¿ %%% !!", "xx", ""),
        document(12, "no_spaces" * 5000),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
