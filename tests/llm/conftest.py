import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int, extra string"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with a column more than usual."""

    def make(rows, extra="extra"):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1]), "x") for r in rows
        ]
        return spark.createDataFrame(full, DOCS).withColumnRenamed("extra", extra)

    return make


@pytest.fixture(scope="session")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


#: texts that every operator on texts has to take
ODD = [None, "", " ", "a", "\n\t ", "ß É 中文", "x" * 50_000, "the cat " * 20_000, "\x00\x1c a", "a  b   c　d"]
