"""The operators' queries against their SQL."""

from __future__ import annotations

import pytest
from compare import bags, connect

from cartulary.llm import registry, sql

SF_DIR = "/root/testdata/sf0.001"


def test_sql_belongs_to_queries():
    assert set(sql.ORACLE) < set(registry.queries())


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op4_line_dedup", "op8_quality_rules"])
def test_query_equals_sql(spark, name):
    names, mine, columns, theirs = bags(registry.queries()[name](spark, SF_DIR), connect(SF_DIR), sql.ORACLE[name])
    assert names == columns and mine == theirs
