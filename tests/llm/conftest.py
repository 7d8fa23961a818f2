import pytest

from cohortspark.session import ensure_checkpoint_dir


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark):
    ensure_checkpoint_dir(spark)


@pytest.fixture(scope="module")
def small(spark):
    """The documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


EDGE_TEXTS = [None, "", " \n\t ", "word", "a b c " * 30000, "same line of ten words that is long enough here\n" * 5, "é" * 50000]


@pytest.fixture(scope="module")
def edges(spark):
    """Null ids, repeated rows and ids, empty, blank and very long texts, and a column with a clashing name."""
    rows = [(i, t, i) for i, t in enumerate(EDGE_TEXTS)] + [(3, "word", 3), (None, "a null id", 0), (None, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, fp long").repartition(3)
