from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from cartulary.session import build_session  # noqa: E402
from cartulary.sources.documents import parse_documents  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def documents(spark):
    """JSON texts → ``path, text, doc, error``, in the order given."""

    def make(*texts: str):
        rows = [(f"/data/{i}.json", text) for i, text in enumerate(texts)]
        return parse_documents(spark.createDataFrame(rows, "path string, text string"), "text")

    return make
