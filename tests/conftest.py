import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabforge.session import local_session, release_all  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tests", memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_all(session)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rng():
    return np.random.default_rng(42)


@pytest.fixture
def frame(spark):
    """Spark table from a dict of equally long columns, split over several partitions."""
    def build(columns, partitions=3):
        names = list(columns)
        rows = [tuple(v.item() if hasattr(v, "item") else v for v in r)
                for r in zip(*columns.values())]
        return spark.createDataFrame(rows, names).repartition(partitions)
    return build


@pytest.fixture
def mixture(frame, rng):
    """200 synthetic mixtures whose strength falls with the ratio and rises with age."""
    n = 200
    cement = rng.triangular(180, 290, 480, n)
    water = rng.uniform(135, 220, n)
    age = rng.gamma(1.6, 14, n) + 1
    ratio = water / cement
    slag = rng.uniform(20, 110, n) * (rng.random(n) < 0.7)
    plasticizer = rng.gamma(2.5, 2.4, n)
    return frame({
        "row_id": np.arange(n),
        "Strength": 62 - 45 * ratio + 4 * np.log(age) + rng.normal(0, 6, n),
        "Age": age, "Cement": cement, "Water": water, "W/C": ratio,
        "Superplasticizer": plasticizer, "Sp/C_pct": plasticizer / cement,
        "Blast Furnace Slag": slag, "Fly Ash": rng.uniform(15, 75, n) * (rng.random(n) < 0.6),
        "Fine Aggregate": rng.triangular(560, 720, 900, n),
        "Coarse Aggregate": rng.triangular(820, 980, 1120, n),
    })
