"""Full refresh: bronze -> silver -> gold, materialised once per refresh.

The source warehouse recomputes its gold views (and their surrogate keys) on every
read. Here each layer is written as parquet under one refresh folder in the
shared checkpoint location, so the keys cannot change between queries of a
refresh, each stage's lineage is cut, and a lost executor only re-runs tasks
of the stage being written.
"""

from __future__ import annotations

import os
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from ..sources import testdata, versions
from ..sources.bronze import (
    conform, ensure_layers, publish_table, read_all_bronze, read_layer, with_audit, within_widths, write_layer,
)
from ..sources.schemas import AUDIT_COL, BRONZE_WIDTHS, GOLD, SILVER
from ..session import application_id, scratch_path
from . import gold as G
from .report_views import create_report_views
from .silver import build_silver_table

# Reporting date used by the registered queries instead of NOW() (reproducible).
DEFAULT_AS_OF = "2002-01-01"


class Warehouse:
    """Materialised silver and gold tables of one refresh."""

    def __init__(self, spark: SparkSession, root: str, home: str | None = None):
        # ``root`` holds this refresh; ``home`` all versions of the warehouse, where it has several.
        self.spark, self.root, self.home = spark, root, home or root
        self.as_of = None
        self.quality: DataFrame | None = None
        # (layer, table) -> check -> rows that violate it, observed while the table was written.
        self.metrics: dict[tuple[str, str], dict[str, int]] = {}
        self.bronze: dict[str, DataFrame] = {}
        self.silver: dict[str, DataFrame] = {}
        self.gold: dict[str, DataFrame] = {}

    def table(self, layer: str, name: str) -> DataFrame:
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}[layer][name]

    def landing(self) -> str:
        """The bronze tables of this refresh written as CSV extracts (source layout), once."""
        from ..sources.bronze import write_extract
        from ..sources.schemas import BRONZE_FILES
        with _LOCK:
            path = os.path.join(self.root, "landing")
            if not getattr(self, "_landing_done", False):
                for table, rel in BRONZE_FILES.items():
                    write_extract(self.bronze[table], os.path.join(path, rel))
                self._landing_done = True
            return path

    def publish(self, as_of=None) -> list[str]:
        """Register every layer in the session catalog: ``bronze.*``, ``silver.*``, ``gold.dim_customers`` ... and the two
        report views ``gold.report_customers`` / ``gold.report_products`` over them (S4, S7). Publishing a later refresh moves
        every view to its tables; ``as_of`` stands for NOW() until another date is set."""
        layers = [("bronze", self.bronze), ("silver", self.silver), ("gold", self.gold)]
        if self.quality is not None:
            layers.append(("quality", {"dq_suite": self.quality}))
        ensure_layers(self.spark, layers=[name for name, _ in layers], root=self.home)
        names = [publish_table(self.spark, self.root, layer, t) for layer, frames in layers for t in frames]
        return names + create_report_views(self.spark, as_of or self.as_of)


def refresh(spark: SparkSession, bronze: dict[str, DataFrame], root: str | None = None, as_of=None,
            fix_gender_case: bool = False, parallel: int = 8,
            run_checks: bool = False, too_wide: str = "keep", keep: int = 2,
            collation: str | None = None) -> Warehouse:
    """Truncate-and-load every layer: bronze, silver (with audit column), then gold.

    Under a given ``root`` the refresh is written as a version of its own and made current when all of it is there
    (:mod:`tierwise.sources.versions`); readers of the previous version, and a refresh that dies, are left whole. Silver
    and gold tables are stored under their declared types. Text beyond its declared width is kept for the checks to
    report, fails the load (``too_wide="fail"``, as COPY does), or goes with its row to ``rejects/<table>``
    (``too_wide="reject"``). Surrogate keys follow the business keys bytewise, or under ``collation``.

    Each table's bronze -> silver chain only depends on its own extract, and
    each dimension only on its own silver inputs, so they are submitted as
    concurrent jobs as soon as their inputs are written (no barrier between
    layers); the fact follows both dimensions. Every table is read back from
    its files, which cuts the lineage. With ``run_checks`` the data-quality
    suite's ``(check, table, violations)`` is written to ``quality/dq_suite``
    and kept as ``wh.quality``.
    """
    from .checks import observed, suite
    version, home = None, root
    if root:
        version, root = versions.new_version(root)
    else:
        root = scratch_path(spark, "refresh")
    wh = Warehouse(spark, root, home)
    wh.as_of = as_of

    def layer(name: str, table: str, df: DataFrame) -> DataFrame:
        counts = observed(wh, name, table)
        seen = Observation(f"{name}.{table}")
        if counts:
            df = df.observe(seen, *[expr.alias(check) for check, expr in counts.items()])
        write_layer(df, root, name, table)
        if counts:
            wh.metrics[name, table] = seen.get
        return read_layer(spark, root, name, table, df.schema)

    def chain(table: str) -> tuple[DataFrame, DataFrame]:
        loaded, rejected = within_widths(bronze[table], BRONZE_WIDTHS[table], too_wide)
        if rejected is not None:
            write_layer(rejected, root, "rejects", table)
        b = layer("bronze", table, loaded)
        one = build_silver_table(table, b, as_of, fix_gender_case)
        return b, layer("silver", table, conform(with_audit(one), SILVER[table]))

    def silver_of(futures, *tables):
        return {t: futures[t].result()[1].drop(AUDIT_COL) for t in tables}

    workers = max(parallel, len(bronze) + 3) if parallel > 1 else 1
    with ThreadPoolExecutor(max_workers=workers) as pool:
        chains = {t: pool.submit(chain, t) for t in bronze}
        dim_c = pool.submit(lambda: layer("gold", "dim_customers", conform(G.dim_customers(
            silver_of(chains, "crm_cust_info", "erp_cust_az12", "erp_loc_a101"), collation), GOLD["dim_customers"])))
        dim_p = pool.submit(lambda: layer("gold", "dim_products", conform(G.dim_products(
            silver_of(chains, "crm_prd_info", "erp_px_cat_g1v2"), collation), GOLD["dim_products"])))
        dims = {"dim_customers": dim_c.result(), "dim_products": dim_p.result()}
        fact = layer("gold", "fact_sales", conform(G.fact_sales(silver_of(chains, "crm_sales_details"), dims),
                                                   GOLD["fact_sales"]))
        wh.bronze = {t: f.result()[0] for t, f in chains.items()}
        wh.silver = {t: f.result()[1] for t, f in chains.items()}
    wh.gold = {**dims, "fact_sales": fact}
    if run_checks:
        wh.quality = layer("quality", "dq_suite", suite(wh))
    if version:
        versions.commit(spark, home, version)
        versions.retire(spark, home, keep)
    return wh


def refresh_from_csv(spark: SparkSession, landing: str, root: str | None = None, as_of=None,
                     files: dict[str, str] | None = None, run_checks: bool = True, **kw) -> Warehouse:
    """The source warehouse's own flow: CSV extracts in ``landing`` -> bronze -> silver -> gold,
    then the data-quality suite."""
    return refresh(spark, read_all_bronze(spark, landing, files), root=root, as_of=as_of,
                   run_checks=run_checks, **kw)


def open_refresh(spark: SparkSession, root: str, as_of=None) -> Warehouse:
    """Re-open the current version under ``root``, or the refresh that was written there itself (e.g. from a new session)."""
    from ..sources.schemas import SILVER_COLUMNS
    home, root = root, versions.current(spark, root) or root
    wh = Warehouse(spark, root, home)
    wh.as_of = as_of
    wh.bronze = {t: read_layer(spark, root, "bronze", t) for t in SILVER_COLUMNS}
    wh.silver = {t: read_layer(spark, root, "silver", t) for t in SILVER_COLUMNS}
    wh.gold = {t: read_layer(spark, root, "gold", t) for t in ("dim_customers", "dim_products", "fact_sales")}
    return wh


_CACHE: dict[tuple, Warehouse] = {}
_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF, refresh_id: str = "") -> Warehouse:
    """The refresh of ``sf_dir`` that this application made under ``refresh_id``; made now if there is none.

    Files aren't watched: after they change, ask under another ``refresh_id``. Another application opens the
    layers of a known root with :func:`open_refresh`.
    """
    key = (application_id(spark), sf_dir, as_of, refresh_id)
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = refresh(spark, testdata.bronze_from_testdata(spark, sf_dir), as_of=as_of)
        return _CACHE[key]
