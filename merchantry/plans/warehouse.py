"""The warehouse layers, built on demand and each written once as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from merchantry import constants as K
from merchantry.operators import clean, dims, facts, rfm
from merchantry.sources.store import TableStore


@dataclass(frozen=True)
class Settings:
    category_rules: Sequence[tuple[str, str]] = tuple(K.CATEGORY_RULES)
    price_edges: Sequence[float] = K.PRICE_EDGES
    money: str = "decimal(10,2)"
    churn_rule: str = "tiered"
    round_to: int | None = 2


class Warehouse:
    """Named layers over staged inputs.

    With a store every layer is written once and later plans read the files, so a lost executor costs only
    its own tasks and reports prune columns. Without one the layers stay lazy views.
    """

    def __init__(
        self,
        spark: SparkSession,
        retail: DataFrame,
        reviews: DataFrame,
        regions: DataFrame | None = None,
        settings: Settings = Settings(),
        store: TableStore | None = None,
    ) -> None:
        self.spark = spark
        self.settings = settings
        self.store = store
        self._tables: dict[str, DataFrame] = {}
        self._builders = {
            "staging_retail": lambda: retail,
            "staging_reviews": lambda: reviews,
            "clean_retail": lambda: clean.clean_retail(
                self["staging_retail"], settings.category_rules, settings.money
            ),
            "clean_reviews": lambda: clean.clean_reviews(self["staging_reviews"]),
            "dim_time": lambda: dims.dim_time(self["clean_retail"]),
            "dim_location": lambda: dims.dim_location(self["clean_retail"], regions),
            "dim_product": lambda: dims.dim_product(
                self["clean_retail"], settings.price_edges, round_to=settings.round_to
            ),
            "rfm_table": lambda: rfm.rfm_table(self["clean_retail"], settings.churn_rule, settings.round_to),
            "dim_customer": lambda: rfm.dim_customer(self["rfm_table"], rfm.modal_country(self["clean_retail"])),
            "fact_orders": lambda: facts.fact_orders(
                self["clean_retail"], self["dim_product"], self["dim_time"], self["dim_location"]
            ),
            "fact_reviews": lambda: facts.fact_reviews(self["clean_reviews"]),
            "final_customer_dataset": lambda: facts.final_customer_dataset(
                self["dim_customer"],
                facts.customer_orders(self["fact_orders"], self["dim_time"], round_to=settings.round_to),
                self["dim_location"],
            ),
            "behaviour_features": lambda: facts.behaviour_features(
                self["fact_orders"], self["dim_product"], self["dim_time"]
            ),
        }

    def register(self, name: str, builder) -> None:
        """Add a layer; the builder may use the other layers."""
        self._builders.setdefault(name, builder)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = self._builders[name]()
            if self.store is not None:
                df = self.store.save(name, df)
            self._tables[name] = df
        return self._tables[name]

    def build_all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in self._builders}
