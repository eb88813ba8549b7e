import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


BASE = ("the quick brown fox jumps over the lazy dog while seven clever birds watch from an old stone wall near "
        "the river and sing until the evening sun goes down behind the distant hills")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns whose names operators use inside."""
    words = BASE.split()
    rows = [
        (1, BASE, "en", "a"), (1, BASE, "en", "a"),              # a repeated row
        (2, BASE, None, None),                                    # an exact copy
        (3, " ".join(words[:-1] + ["mountains"]), "en", "b"),     # a near copy
        (None, BASE + " again", "en", "b"), (None, None, None, None),
        (4, None, "en", "a"), (5, "", "en", "a"), (6, " \n\t ", "en", "a"), (7, "one", "en", "a"),
        (8, "a\x00b \x1c c " + "é" * 30, "fr", "a"),
        (9, " ".join(f"w{i}" for i in range(60_000)), "de", "c"),
        (10, "x" * 300_000, "de", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ["n_words", "node", "bands", "bucket", "label", "starts", "text_hash", "words", "leaf", "line", "kept", "hit", "ids",
             "score", "n", "rep", "own", "key", "row", "sequence_id"]
    for c in clash:
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
