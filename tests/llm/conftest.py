import pyspark.sql.types as T
import pytest

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

ODD_TEXTS = [
    None, "", " ", "a", "one two", "one two three four", "  lead and   trail  ", "tab\tand\nline\r\nend", "▁mark ▁", "<|endoftext|> x<|endoftext|>y",
    "Été naïve \U0001f600 你好  nbsp\x85 \x1c z", "é H̱ Σας Σ", "same text here for all of us", "same text here for all of us",
    "long " * 3000, "x" * 5000, "<s> </s> <unk> [CLS]", "<|ENDOFTEXT|> A<|EndOfText|>B <|startoftext|>C<D", "it's we'll DON'T I'm 123 4,5.6 #$%^",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 4 else None, 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "null id", "en", "s1", 1), (3, "another row with id three", "en", "s1", 2)]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("n_tokens", "size", "key", "hash", "h", "measure", "range", "component_id", "score", "digest"):
        frame = frame.selectExpr("*", f"'clash' as {name}")
    return frame.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
