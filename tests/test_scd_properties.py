"""Type-2 merge against a direct simulation of the three sequential steps."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmart import schemas
from sparkmart.operators import scd

T0 = dt.datetime(2020, 1, 1)
NOW = dt.datetime(2021, 1, 1)
AS_OF = dt.date(2021, 1, 1)
START = dt.date(2000, 1, 1)
PRICES = [Decimal("1.00"), Decimal("2.00"), Decimal("3.00"), None]


@st.composite
def scenario(draw):
    """A dimension with valid history and a staging batch with unique ids."""
    dim, key = [], 0
    for pid in range(draw(st.integers(0, 6))):
        n_closed = draw(st.integers(0, 2))
        has_current = draw(st.booleans()) or n_closed == 0
        day = dt.date(2001, 1, 1)
        for i in range(n_closed):
            key += 1
            end = day + dt.timedelta(days=30)
            dim.append((key, pid, f"p{pid}", "c", Decimal(f"{i + 1}.00"), True, day, end, False, T0))
            day = end
        if has_current:
            key += 1
            price = draw(st.sampled_from(PRICES[:3]))
            dim.append((key, pid, f"p{pid}", "c", price, True, day, None, True, T0))
    ids = draw(st.lists(st.integers(0, 8), unique=True, max_size=8))
    stg = [(pid, f"s{pid}", "c", draw(st.sampled_from(PRICES)), True) for pid in ids]
    return dim, stg


def simulate(dim, stg):
    rows = [list(r) for r in dim]
    by_id = {s[0]: s for s in stg}
    for r in rows:  # step 1: expire changed current versions (NULL never differs)
        s = by_id.get(r[1])
        if s and r[8] and r[4] is not None and s[3] is not None and r[4] != s[3]:
            r[7], r[8], r[9] = AS_OF, False, NOW
    top = max((r[0] for r in rows), default=0)
    nxt = top + 1 if top >= 1 else 1
    step2 = sorted(p for p in by_id if any(r[1] == p for r in rows) and not any(r[1] == p and r[8] for r in rows))
    step3 = sorted(p for p in by_id if not any(r[1] == p for r in rows))
    for start, ids in ((AS_OF, step2), (START, step3)):
        for p in ids:
            s = by_id[p]
            rows.append([nxt, p, s[1], s[2], s[3], s[4], start, None, True, NOW])
            nxt += 1
    return sorted(tuple(r) for r in rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(scenario())
def test_scd2_matches_sequential_steps(spark, case):
    dim_rows, stg_rows = case
    dim = spark.createDataFrame(dim_rows, schemas.DIM_PRODUCT)
    stg = spark.createDataFrame(
        stg_rows, "product_id long, product_name string, category_name string, unit_price decimal(10,2), is_active boolean"
    )
    got = sorted(tuple(r) for r in scd.scd2_merge(dim, stg, AS_OF, NOW, START).collect())
    assert got == simulate(dim_rows, stg_rows)


NAMES = ["a", "b", None]


@st.composite
def facility_case(draw):
    ids = draw(st.lists(st.integers(0, 8), unique=True, max_size=6))
    dim = [
        (i + 1, pid, draw(st.sampled_from(NAMES[:2])), "t", draw(st.sampled_from(NAMES)), "r", T0)
        for i, pid in enumerate(sorted(ids))
    ]
    stg_ids = draw(st.lists(st.integers(0, 10), unique=True, max_size=8))
    stg = [(pid, draw(st.sampled_from(NAMES[:2])), "t", draw(st.sampled_from(NAMES)), "r") for pid in stg_ids]
    return dim, stg


def simulate_scd1(dim, stg):
    by_id = {s[0]: s for s in stg}
    rows = []
    for d in dim:  # UPDATE ... FROM: every attribute from staging, NULLs included
        s = by_id.get(d[1])
        if s is None:
            rows.append(d)
        else:
            changed = (d[2], d[3], d[4], d[5]) != (s[1], s[2], s[3], s[4])
            rows.append((d[0], d[1], s[1], s[2], s[3], s[4], NOW if changed else d[6]))
    top = max((d[0] for d in dim), default=0)
    nxt = top + 1 if top >= 1 else 1
    known = {d[1] for d in dim}
    for pid in sorted(p for p in by_id if p not in known):  # INSERT the new ids
        s = by_id[pid]
        rows.append((nxt, pid, s[1], s[2], s[3], s[4], NOW))
        nxt += 1
    return sorted(rows, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(facility_case())
def test_scd1_matches_update_then_insert(spark, case):
    dim_rows, stg_rows = case
    dim = spark.createDataFrame(dim_rows, schemas.DIM_FACILITY)
    stg = spark.createDataFrame(
        stg_rows, "facility_id long, facility_name string, facility_type string, country_name string, region_name string"
    )
    got = sorted((tuple(r) for r in scd.scd1_merge(dim, stg, NOW).collect()), key=repr)
    assert got == simulate_scd1(dim_rows, stg_rows)
