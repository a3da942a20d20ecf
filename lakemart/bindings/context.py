"""The pipeline's tables built lazily over one test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.bindings import tables
from lakemart.functions import stable_key
from lakemart.plans import dims, facts, marts
from lakemart.plans.staging import STAGED, cleaned_ids, stage, staged_keys
from lakemart.session import work_path
from lakemart.sources.lake import Lake
from lakemart.sources.raw_load import raw_table


class Context:
    """Each table is built on first use and then shared within one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def table(self, name: str) -> DataFrame:
        return self._once(name, lambda: tables.table(self.spark, self.sf_dir, name))

    def raw(self, name: str) -> DataFrame:
        build = getattr(tables, f"raw_{name}")
        return self._once(f"raw_{name}", lambda: build(self.spark, self.sf_dir))

    def staged(self, name: str) -> DataFrame:
        return self._once(f"stg_{name}", lambda: stage(name, self.raw(name)))

    def keep(self, *names: str) -> None:
        """Rank the RAW history of these data sets once, for all branches of the query that read them."""
        for name in names:
            path = work_path(self.spark, f"stg_{name}")
            staged = self.staged(name)
            staged.write.parquet(path)
            self._built[f"stg_{name}"] = self.spark.read.schema(staged.schema).parquet(path)

    def lake(self, only: dict[str, str] | None = None) -> Lake:
        """A lake whose RAW tables hold the test tables; ``only`` filters those of some data sets."""
        lake = Lake(self.spark, work_path(self.spark, "lake"))
        with lake.transaction() as tx:
            for name in STAGED:
                rows = self.raw(name)
                tx.append(raw_table(name), rows.filter(only[name]) if only and name in only else rows)
        return lake

    def ids(self, name: str) -> DataFrame:
        return self._once(f"ids_{name}", lambda: staged_keys(name, self.raw(name)))

    def seen(self, name: str) -> DataFrame:
        return self._once(f"seen_{name}", lambda: cleaned_ids(name, self.raw(name)))

    def dim(self, name: str) -> DataFrame:
        builders = {
            "date": lambda: dims.dim_date(self.staged("orders"), self.staged("order_items")),
            "customer": lambda: dims.dim_customer(
                self.staged("customers"), self.staged("geolocation")
            ),
            "product": lambda: dims.dim_product(
                self.staged("products"), self.staged("category_translation")
            ),
            "seller": lambda: dims.dim_seller(self.staged("sellers"), self.staged("geolocation")),
        }
        return self._once(f"dim_{name}", builders[name])

    def fact(self, name: str) -> DataFrame:
        builders = {
            "order_items": lambda: facts.fact_order_items(
                self.staged("order_items"),
                self.staged("orders"),
                self.ids("customers"),
                self.ids("products"),
                self.ids("sellers"),
                seen_items=self.seen("order_items"),
                seen_orders=self.seen("orders"),
            ),
            "payments": lambda: facts.fact_payments(
                self.staged("payments"),
                self.staged("orders"),
                self.ids("customers"),
                seen_payments=self.seen("payments"),
                seen_orders=self.seen("orders"),
            ),
            "order_lifecycle": lambda: facts.fact_order_lifecycle(
                self.staged("orders"),
                self.staged("order_items"),
                self.staged("payments"),
                self.ids("customers"),
                seen_orders=self.seen("orders"),
            ),
        }
        return self._once(f"fact_{name}", builders[name])

    def mart(self, name: str) -> DataFrame:
        lifecycle = "order_lifecycle"
        builders = {
            "executive_kpis": lambda: marts.mart_executive_kpis(self.fact(lifecycle)),
            "sales_daily": lambda: marts.mart_sales_daily(self.fact(lifecycle), self.dim("date")),
            "category_performance": lambda: marts.mart_category_performance(
                self.fact("order_items"),
                self.dim("product"),
                self.seen("order_items").select(stable_key("product_id").alias("product_key")),
            ),
            "state_performance": lambda: marts.mart_state_performance(
                self.fact(lifecycle), self.dim("customer")
            ),
            "order_status": lambda: marts.mart_order_status(self.fact(lifecycle)),
        }
        return self._once(f"mart_{name}", builders[name])
