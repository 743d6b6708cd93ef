from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from delinq.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def domain(spark, small):
    """The four source tables and the master table on the smallest data set."""
    from delinq.operators.master import build_master
    from delinq.session import materialise
    from delinq.sources import adapters

    tables = {
        name: getattr(adapters, name)(spark, small) for name in ("borrowers", "education", "loans", "payments")
    }
    tables["master"] = materialise(build_master(**tables), "master")
    return tables
