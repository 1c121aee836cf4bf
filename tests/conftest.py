import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from fluxwatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4")


@pytest.fixture
def small_blocks(monkeypatch):
    """Cuts series into blocks of 64 positions, groups of 3 blocks."""
    from fluxwatch.operators.timeseries import blocks, compare, frame, linear, recursion, single, volatility

    for module in (blocks, compare, frame, linear, recursion, single, volatility):
        monkeypatch.setattr(module, "BLOCK", 64)
    for module in (blocks, recursion):
        monkeypatch.setattr(module, "FAN", 3)
