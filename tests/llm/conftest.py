import pytest

# One small table of odd rows; the extra columns clash with names that the operators use inside.
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta", "en", "a"),
    (2, "Alpha beta  gamma delta epsilon\nzeta eta theta", "en", "a"),
    (3, "alpha BETA gamma delta epsilon zeta eta theta", "en", None),
    (4, "", "en", "b"),
    (5, None, None, "b"),
    (6, " \t\n", None, None),
    (7, "12345 !!! ###", "de", "c"),
    (8, "der die das und ist nicht mit auf für über " * 3000, "de", "c"),
    (9, "one two", None, "a"),
    (9, "one two", None, "a"),
    (None, "one two", "en", "a"),
    (None, None, None, None),
    (10, "Привет мир <|endoftext|> it's 42 \x1c   \U0001f642 don't", "ru", "d"),
    (11, "ONE TWO", "en", "a"),
]
EXTRA = "1 AS id, 'x' AS kept, 2 AS digest, 3 AS row_hash, 'y' AS node, 4.5 AS u, 5 AS n, 'z' AS ids, 6 AS mix_p, 7 AS w, 8 AS stay_id"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").selectExpr(
        "*", *[x.strip() for x in EXTRA.split(",")])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def bpe_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(bpe_path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_path)
