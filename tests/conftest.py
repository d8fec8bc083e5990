import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def curve():
    """One noisy series around 1, as a pandas frame."""
    rng = np.random.default_rng(7)
    return pd.DataFrame(
        {
            "id": "a",
            "time": np.linspace(0, 100, 1000),
            "flux": 1 + 0.01 * rng.standard_normal(1000),
            "flux_err": 0.001,
        }
    )
