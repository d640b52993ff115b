from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from streamlake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4)
    yield session
    session.stop()


@pytest.fixture
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def lake(tmp_path):
    from streamlake.plans.pipelines import Lake

    return Lake(str(tmp_path / "lake"))


def event(**changes) -> dict:
    """One record that conforms to the contract."""
    base = {
        "event_id": "5f0c9d7e-41ab-4e0b-9c55-d2a97be01f36",
        "user_id": "listener-42",
        "track_id": "song-77",
        "artist_name": "The Quiet Harbour",
        "played_at": "2025-03-04T21:47:09Z",
        "duration_seconds": 246,
        "platform": "desktop",
        "ingest_date": "2025-03-05",
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not ...}


def uuid_of(n: int) -> str:
    return f"00000000-0000-4000-8000-{n:012d}"
