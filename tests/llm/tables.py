import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def write_table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def write_documents(spark, folder, rows):
    """rows: (doc_id, text, lang, source)."""
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return write_table(spark, folder, "documents", full, DOCUMENTS)


ODD_TEXTS = [
    None, "", " ", "\n", "a", "It's the cat's 2 mice, isn't it?", "  two  blanks\n\n\nthree lines \t tab ", "naïve café — “quoted”… 日本語 😀😀",
    "\x00\x1c 　​ odd\x0bspace\x85here   ", "<|endoftext|> </s>[INST] <|startoftext|>", "x" * 5000, "ab " * 4000,
    "İſK é ́ Σας", "word,word. (word) 3.14 a_b -- !!", "a", "tail \n",
]


@pytest.fixture
def odd_documents(spark, tmp_path):
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}") for i, t in enumerate(ODD_TEXTS)]
    rows.append(rows[5])  # a repeated row
    return write_documents(spark, tmp_path / "odd", rows), rows


@pytest.fixture
def no_documents(spark, tmp_path):
    return write_documents(spark, tmp_path / "none", [])
