"""The driver contract: every registered query has an oracle, and outputs are well-formed."""
import re

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from tierwise.plans.registry import all_queries
    q, o = E.queries(), E.oracle_sql()
    own = set(all_queries())
    assert own <= set(q) and own <= set(o) and set(o) <= set(q)
    q = {k: q[k] for k in own}
    assert all(re.match(r"(q\d\d|e\d\d|g\d\d|s\d\d|silver|gold|dq)_", name) for name in q)


def test_outputs_have_unique_lowercase_columns(spark):
    from tierwise.plans.registry import all_queries
    for name, fn in all_queries().items():
        cols = fn(spark, SF).columns
        assert len(cols) == len(set(cols)), name
        assert all(c == c.lower() for c in cols), name
