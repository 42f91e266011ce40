from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from touchcredit.session import get_session
    s = get_session("local[4]", 4, app_name="touchcredit-tests",
                    extra={"spark.sql.session.timeZone": "UTC"})
    yield s
    import __spark_entry__ as E
    E.drop_pipelines()
    s.stop()
