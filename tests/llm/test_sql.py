import pytest
from compare import connect, differences

from pulsetrail.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, size):
    data = f"/root/testdata/{size}"
    assert differences(QUERIES[name](spark, data), connect(data), SQL[name]) is None
