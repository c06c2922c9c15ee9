import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import ODD  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows as documents with extra columns whose names clash with inner ones."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, words string, score int, label string, "
              "block int, bucket string, key int, comp long, pos string, held_out string, tokens string, edges int, cid int")
    return spark.createDataFrame([(d, t, None, None, None, "w", 1, "l", 2, "b", 3, 4, "p", "h", "t", 5, 6) for d, t in ODD], schema)


@pytest.fixture(scope="session")
def none(odd):
    """No documents."""
    return odd.limit(0)


@pytest.fixture()
def as_table(spark, tmp_path):
    """Writes a frame as a table and reads it back."""
    made = iter(range(100))

    def write(df):
        path = str(tmp_path / f"t{next(made)}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write
