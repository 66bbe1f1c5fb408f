"""Pure (storage-free) medallion flow over the analog extracts: bronze → silver → gold frames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from terrace.contracts import ENTITIES, RULES
from terrace.operators.conform import conform
from terrace.operators.dedupe import latest_per_key
from terrace.operators.quality import flag_rules, rejected, valid
from terrace.operators import star
from terrace.plans import analog
from terrace.plans.analog import RUN_DATE, Tables


class _Lazy(Mapping):
    """Read-only mapping whose values are built on first access (plans are built only when used)."""

    def __init__(self, names, build):
        self._names, self._build, self._done = tuple(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._done:
            self._done[name] = self._build(name)
        return self._done[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


@dataclass
class SilverStep:
    flagged: DataFrame
    valid: DataFrame
    rejected: DataFrame
    silver: DataFrame


def silver_step(bronze_df: DataFrame, entity_name: str, as_of: str = RUN_DATE) -> SilverStep:
    """Conform → flag rules → split → latest per key, all lazy."""
    entity = ENTITIES[entity_name]
    flagged = flag_rules(conform(bronze_df, entity), RULES[entity_name], as_of)
    good = valid(flagged)
    return SilverStep(flagged, good, rejected(flagged), latest_per_key(good, entity.key))


def conformed(t: Tables, entity_name: str) -> DataFrame:
    return t.remember(("conformed", entity_name), lambda: conform(analog.bronze(t, entity_name), ENTITIES[entity_name]))


def silver_steps(t: Tables, as_of: str = RUN_DATE) -> Mapping[str, SilverStep]:
    return t.remember(("steps", as_of), lambda: _Lazy(ENTITIES, lambda name: silver_step(analog.bronze(t, name), name, as_of)))


def silver_entity(t: Tables, name: str, as_of: str = RUN_DATE, payload_only: bool = True) -> DataFrame:
    df = silver_steps(t, as_of)[name].silver
    if not payload_only:
        return df
    return t.remember(("silver_payload", name, as_of), lambda: df.select(*ENTITIES[name].column_names))


def silver_frames(t: Tables, as_of: str = RUN_DATE) -> Mapping[str, DataFrame]:
    return t.remember(("silver", as_of), lambda: _Lazy(ENTITIES, lambda name: silver_entity(t, name, as_of, payload_only=False)))


def gold_frames(t: Tables, as_of: str = RUN_DATE) -> Mapping[str, DataFrame]:
    """The seven gold tables over the analog silver, each planned only when asked for."""
    return t.remember(("gold", as_of), lambda: gold_plans(silver_frames(t, as_of), as_of))


def gold_plans(silver: Mapping[str, DataFrame], as_of: str | None, located_sales: DataFrame | None = None) -> Mapping[str, DataFrame]:
    """Plans of the seven gold tables over five silver frames, each made when asked for. Both the
    queries and the lake's gold job take them from here; the job gives the located sales, stored."""
    sales = [] if located_sales is None else [located_sales]

    def located() -> DataFrame:
        if not sales:
            sales.append(star.located_sales(silver["sales_transactions"], silver["properties"]))
        return sales[0]

    plans = {
        "dim_property": lambda: star.dim_property(silver["properties"]),
        "dim_agent": lambda: star.dim_agent(silver["agents"]),
        "fact_sales": lambda: located().drop("place"),
        "fact_leases": lambda: star.fact_leases(silver["leases"]),
        "fact_listings": lambda: star.fact_listings(silver["listings"], as_of),
        "dim_date": lambda: star.dim_date({t: gold[t] for t in star.FACT_DATES}),
        "agg_market_monthly": lambda: star.market_monthly(located()),
    }
    gold = _Lazy(star.GOLD_TABLES, lambda name: plans[name]())
    return gold
