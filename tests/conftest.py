import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradeflow.schemas import FLOWS
from tradeflow.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        # The suite runs more than the 1,000 queries that are kept by default; a test counts on none being dropped.
        "spark.sql.ui.retainedExecutions": "100000",
    }
    session = local_session(4, "tests", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def flows(spark):
    """Builds a flows table from short rows: (year, month, reporter, partner, weight[, special])."""

    def build(*rows):
        full = [
            (
                y, m, r, f"R{r}", p, None if p is None else f"P{p}", None, None,
                rest[0] if rest else False, w, 1.0, False,
            )
            for y, m, r, p, w, *rest in rows
        ]
        return spark.createDataFrame(full, FLOWS)

    return build


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as plain tuples, sorted, optionally of some columns only."""

    def listed(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return listed
