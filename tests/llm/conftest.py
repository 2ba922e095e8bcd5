import pytest

from fleetscope.llm.common import ship_package

LONG = "word " * 50_000 + "end"


@pytest.fixture(scope="session")
def shipped(spark):
    ship_package(spark)
    return spark


def documents(spark, texts, start=1, source="s"):
    """Documents with columns whose names the operators use themselves."""
    rows = [(start + i, t, "en", source if isinstance(source, str) else source[i % len(source)], len(t or ""), 1, "x", 2, 3.0, "y")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "row long, doc string, n int, score double, line string")
