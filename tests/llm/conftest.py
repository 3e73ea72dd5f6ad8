import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from corpus import corpus  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns that clash with result and helper names."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, "
              "`_w` string, size string, shard int, component string")
    return spark.createDataFrame(
        [(i, t, "en" if n % 3 else None, f"src{n % 4}" if n % 7 else None, len(t or ""), "x", "y", "z", "big", 1, "c")
         for n, (i, t) in enumerate(rows)], schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
