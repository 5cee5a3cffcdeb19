"""The operators that SQL can express against their DuckDB formulation on sf0.001."""

import pytest

from poolbook.llm import queries
from tests.test_oracle import assert_same, duck  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):  # noqa: F811
    assert_same(queries.QUERIES[name](spark, SF), duck, queries.ORACLE[name])
