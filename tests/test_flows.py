"""The cheapest open lane first, against a table of all lanes; and many cities in little memory."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from stockloom.operators import allocation as al
from stockloom.operators.lanes import all_km


def cities(n, seed, ties=False):
    pick = np.random.default_rng(seed)
    gives, amount = pick.random(n) < 0.5, pick.integers(1, 100, n)
    digits = 0 if ties else 6
    return pa.table({
        "product_id": pa.array([1] * n, pa.int32()), "city_id": pick.permutation(n).astype(np.int32),
        "s": np.where(gives, amount, 0), "d": np.where(gives, 0, amount),
        "lat": np.round(pick.uniform(30, 50, n), digits), "lon": np.round(pick.uniform(-115, -70, n), digits),
        "base": np.full(n, 300.0) if ties else pick.uniform(100, 900, n), "make": pick.uniform(20, 80, n),
    })


def over_all_lanes(left, longest, holding):
    rows = sorted(left.to_pylist(), key=lambda r: r["city_id"])
    lanes = []
    for a in rows:
        for b in rows:
            if a["s"] > 0 and b["d"] > 0:
                km = all_km(*[np.array([v]) for v in (a["lat"], a["lon"], b["lat"], b["lon"])])[0, 0]
                unit = (a["base"] + b["base"]) / 2 * (0.5 + 0.5 * km / longest) * al.TRANSPORT_SCALE
                unit = round(al.MISSING_UNIT_LANE_COST if np.isnan(unit) else float(np.round(unit, 6)), 6)
                if unit <= b["make"] + holding:
                    lanes.append((unit, a["city_id"], b["city_id"]))
    have, need = {r["city_id"]: r["s"] for r in rows}, {r["city_id"]: r["d"] for r in rows}
    flows = []
    for _, a, b in sorted(lanes):
        quantity = min(have[a], need[b])
        if quantity:
            flows.append((a, b, quantity))
            have[a] -= quantity
            need[b] -= quantity
    return flows


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("ahead", [64, 1])
def test_flows_equal_those_over_all_lanes(monkeypatch, ties, ahead):
    monkeypatch.setattr(al, "LANES_AHEAD", ahead)
    for seed in range(6):
        left = cities(5 + 12 * seed, seed, ties)
        if seed == 3:
            left = left.set_column(left.column_names.index("lat"), "lat", pa.array([np.nan, *left["lat"].to_pylist()[1:]]))
        got = [(r["from_city"], r["to_city"], r["flow"]) for r in al.cheapest_flows(left, 5000.0, 1.0).to_pylist()]
        assert got == over_all_lanes(left, 5000.0, 1.0)


def test_ten_thousand_cities_in_little_memory():
    left = cities(10_000, 1)
    tracemalloc.start()
    flows = al.cheapest_flows(left, 5000.0, 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert flows.num_rows > 5000
    assert peak < 200 << 20  # a table of all lanes has 25 million cells of 8 bytes, and more than one of them
