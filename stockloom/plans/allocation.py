"""From assembled inputs to transfers, production, final stock, costs and result records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from stockloom.functions import inventory as inv
from stockloom.operators import allocation as al
from stockloom.operators import capacity as cp
from stockloom.operators import lanes as ln
from stockloom.operators import results as rs
from stockloom.operators.ordered import IDS_PER_CHUNK
from stockloom.session import settle


@dataclass
class Allocation:
    """The tables of one run. `targets`, `plan`, `flows` and the priced moves are stored, the last when first asked for;
    the others are computed from them on use."""

    targets: DataFrame
    plan: DataFrame
    flows: DataFrame
    store_city: DataFrame
    cities: DataFrame
    longest_km: float
    capacity: float = inv.STORE_CAPACITY
    _priced: DataFrame | None = field(default=None, repr=False)

    def moves(self) -> DataFrame:
        return al.moves(self.plan, self.flows)

    def priced(self) -> DataFrame:
        """The moves above the smallest quantity with their costs. Only lanes that occur are priced."""
        if self._priced is None:
            kept = settle(self.moves())
            lanes = ln.city_lanes(ln.city_pairs(kept, self.store_city), self.cities, self.longest_km)
            self._priced = settle(al.priced_transfers(kept, self.store_city, lanes))
        return self._priced

    def transfers(self) -> DataFrame:
        return al.transfer_reasons(self.priced(), self.targets)

    def production(self) -> DataFrame:
        return al.production_reasons(al.production(self.plan, self.targets), self.targets, self.capacity)

    def final_inventory(self) -> DataFrame:
        return al.final_inventory(self.plan)

    def audit(self) -> DataFrame:
        return al.audit(self.plan, self.moves(), self.capacity)

    def costs(self) -> DataFrame:
        return al.cost_summary(self.priced(), al.production(self.plan, self.targets), self.plan)

    def lower_bound(self) -> DataFrame:
        return cp.bound_with_prices(self.plan, self.targets, self.cities, self.capacity)

    def overflow(self) -> DataFrame:
        """Production no plan can place."""
        return al.capacity_overflow(self.plan, self.capacity)

    def transfer_records(self, scenario: str) -> DataFrame:
        return rs.transfer_records(self.transfers(), self.targets, scenario)

    def manufacturing_records(self, scenario: str) -> DataFrame:
        return rs.manufacturing_records(al.production_by_product(self.production()), scenario)

    def scenario_record(self, scenario: str) -> DataFrame:
        return rs.scenario_delta(self.costs(), self.plan, self.targets, scenario)

    def summary(self, scenario: str) -> DataFrame:
        return rs.run_summary(self.costs(), scenario)


def allocate(
    assembled: DataFrame,
    store_city: DataFrame,
    cities: DataFrame,
    longest_km: float,
    capacity: float = inv.STORE_CAPACITY,
    width: int = IDS_PER_CHUNK,
) -> Allocation:
    """Set targets and plan the flows, production within the capacity of the stores."""
    return allocate_within(assembled, store_city, cities, longest_km, [capacity], width)[0]


def allocate_within(
    assembled: DataFrame,
    store_city: DataFrame,
    cities: DataFrame,
    longest_km: float,
    capacities: Sequence[float],
    width: int = IDS_PER_CHUNK,
) -> list[Allocation]:
    """One run per capacity. What does not depend on it is made once.

    The targets (one row per store and product) are stored before planning: the plan, the reasons and
    the costs all read them, and the demand history behind them is far larger. Store cities and city parameters
    are read by several results too, so pass stored tables.
    """
    targets = settle(al.with_target(assembled))
    balance = settle(al.balances(targets, width))
    free = al.plan_flows(balance, cities, longest_km)
    plans = [cp.plan_within(balance, *free, cities, longest_km, c, width) for c in capacities]
    return [Allocation(targets, *p, store_city, cities, longest_km, c) for c, p in zip(capacities, plans)]
