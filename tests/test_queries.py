"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import bags, connect

import __spark_entry__ as entry
from cartulary.plans import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    names, mine, columns, theirs = bags(QUERIES[name](spark, SF_DIR), con, SQL[name])
    assert names == columns
    assert mine == theirs


@pytest.mark.parametrize("name", ["v15_online_verdicts", "v16_online_totals"])
def test_probes_of_one_time_have_one_outcome(spark, tmp_path, name):
    """Pages that share a URL also share its probes, in either order of their outcomes."""
    pages = [(7 * i + k, f"http://example.com/{i}", "") for i in range(200) for k in ((1, 2) if i % 2 else (2, 1))]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.parquet")
    (tmp_path / "pages.parquet").symlink_to(part)
    names, mine, columns, theirs = bags(QUERIES[name](spark, str(tmp_path)), connect(str(tmp_path)), SQL[name])
    assert names == columns
    assert mine == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
