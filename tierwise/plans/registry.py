"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import checks as C
from . import queries as Q
from . import reports as R
from .warehouse import DEFAULT_AS_OF, warehouse_for

Runner = Callable[[SparkSession, str], DataFrame]


def _on_gold(fn) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir).gold)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _report(fn) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir).gold, DEFAULT_AS_OF)
    run.__name__ = fn.__name__
    return run


def analytic_queries() -> dict[str, Runner]:
    out = {name: _on_gold(getattr(Q, name)) for name in sorted(dir(Q)) if name[:1] == "q" and name[1:3].isdigit()}
    out["q20_customer_report"] = _report(R.customer_report)
    out["q21_product_report"] = _report(R.product_report)
    return out


def _check(spec) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spec.spark(warehouse_for(spark, sf_dir))
    run.__name__ = spec.name
    return run


def _table(builder) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(warehouse_for(spark, sf_dir))
    return run


def _latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.testdata import load_tables
    return C.latest_lineitem(load_tables(spark, sf_dir, ("lineitem",))["lineitem"])


def _suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.suite(warehouse_for(spark, sf_dir))


def table_queries() -> dict[str, Runner]:
    out = {name: _table(b) for name, (b, _) in {**C.TABLES, **C.OPERATORS, **C.CSV_INGEST}.items()}
    out["e01_latest_lineitem"] = _latest_lineitem
    return out


def check_queries() -> dict[str, Runner]:
    out = {f"dq_{c.name}": _check(c) for c in C.CHECKS}
    out["dq_suite"] = _suite
    return out


def all_queries() -> dict[str, Runner]:
    return {**analytic_queries(), **table_queries(), **check_queries()}


def all_sql() -> dict[str, str]:
    from .oracle import PIPELINE, QUERIES, int_date
    out = dict(QUERIES)
    for name, (_, sql) in {**C.TABLES, **C.CSV_INGEST}.items():
        out[name] = PIPELINE + "\n" + sql
    out["e01_latest_lineitem"] = C.LATEST_LINEITEM_SQL
    for name, (_, sql) in C.OPERATORS.items():
        body = sql.format(as_of=DEFAULT_AS_OF, **{c: int_date(c) for c in ("sls_order_dt", "sls_ship_dt",
                                                                            "sls_due_dt")})
        out[name] = PIPELINE + "\n" + body
    for c in C.CHECKS:
        out[f"dq_{c.name}"] = PIPELINE + "\n" + c.sql.format(as_of=DEFAULT_AS_OF)
    out["dq_suite"] = PIPELINE + "\n" + C.suite_sql(DEFAULT_AS_OF)
    return out
