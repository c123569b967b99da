import pytest

from check_oracle import compare
from machinewatch.llm.queries import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(ready, name):
    status, detail = compare(ready, "/root/testdata/sf0.001", [name], verbose=False)[name]
    assert status == "OK", detail
