from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arqueo.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="arqueo-tests", shuffle_partitions=4)
    yield s
    s.stop()


def D(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def rows(df, *cols, order=None):
    """Collect selected columns as sorted tuples (NULLs first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))
