import pytest

from docketry.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(compare, name):
    compare(queries.QUERIES[name], queries.ORACLE_SQL[name])
