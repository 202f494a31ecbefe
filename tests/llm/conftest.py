import public_tokenizers
import pytest

TEXTS = [
    "The first text has a few words, and they are plain ones.",
    "The first text has a few words, and they are plain ones.",
    "",
    None,
    "one",
    "  odd   blanks\t here \n\n and there ",
    "<|endoftext|> It's ünïcode ßtraße, 12345!\nNext line.",
    "long " * 3000 + "end",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i if i != 5 else None, text, ["en", "de", None][i % 3], ["a", "b", None][i % 3]) for i, text in enumerate(TEXTS)]
    rows += [rows[0], (3, "same number, other text", "en", "a"), (None, None, None, None)]
    shape = "doc_id long, text string, lang string, source string"
    extra = "lit(7) as `Shard`, 'x' as `key`, 1.5 as `row`, 'y' as `number`, 2 as `host`, 0 as `a.b`"
    parts = [part.strip() for part in extra.replace("lit(7)", "7").split(",")]
    return spark.createDataFrame(rows, shape).selectExpr("*", *parts)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("1 = 0")


@pytest.fixture(scope="session")
def words_file():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def bytes_file():
    return public_tokenizers.path("byte_bpe_50k.json")
