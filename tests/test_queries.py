import pytest
from oracle import SF, same_rows

from pagemart.plans import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, SF), queries.SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


def test_registry():
    from pagemart.plans.registry import Registry

    r = Registry("thing")
    r.register("a")(1)
    assert r["a"] == 1 and dict(r) == {"a": 1}
    with pytest.raises(ValueError):
        r.add("a", 2)
    with pytest.raises(KeyError, match="no thing b"):
        r["b"]
