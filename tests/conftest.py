from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from retail_spark.session import build_session

    scratch = tempfile.mkdtemp(prefix="retail-tests-")
    s = build_session(
        "local[4]",
        shuffle_partitions=4,
        extra={
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.sql.ansi.enabled": "true",
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Rows as tuples (selected columns), sorted with NULLs first."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))
