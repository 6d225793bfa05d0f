import pytest

#: Texts that every operator must take: null, empty, blank, one word, very long, repeated, not ASCII.
ODD_TEXTS = [None, "", " \n\t", "word", "naïve café – “quoted” 日本語", "x" * 30_000,
             " ".join(f"w{i % 701}" for i in range(20_000)), "same text here", "same text here"]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables need few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def odd_docs(spark):
    """Odd texts with null and repeated ids, null labels, a repeated row, and columns whose names invite clashes."""
    rows = [(i, t, None if i % 3 else "en", None if i == 2 else "s", None, i, f"u{i}") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a row without an id", "en", "s", 1, 1, "u"), rows[-1], (0, "an id again", "de", "s", 1, 1, "u")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, hash long, uid string")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
