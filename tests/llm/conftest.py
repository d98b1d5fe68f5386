import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def frame(spark):
    """Texts by id as a table, with further columns whose names operators use themselves."""
    from tapeloom.llm.shipping import ship

    ship(spark)

    def make(texts):
        rows = [(i, x, "s", "k", i) for i, x in (texts.items() if isinstance(texts, dict) else texts)]
        names = "doc_id long, text string, source string, kept string, n long"
        return spark.createDataFrame(rows, names)

    return make
