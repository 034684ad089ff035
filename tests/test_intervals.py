"""As-of and band joins by stretches of time against plain loops."""

import datetime as dt
import random

import pytest

from tickloom.functions.core import asof_join
from tickloom.functions.intervals import asof_in_stretches, near_join


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def sides(spark):
    r = random.Random(6)
    left = [(r.choice("AB") if r.random() < 0.9 else None, day(r.randrange(-400, 1500)) if r.random() < 0.95 else None, i) for i in range(300)] + [("C", day(5), 900)]
    right = [(r.choice("AB"), day(r.randrange(0, 1200)), float(i), f"x{i}") for i in range(40)] + [("A", None, 1.0, "none"), ("D", day(3), 7.0, "d")]
    right += [("A", right[0][1], 99.0, "tie")]
    return left, right, spark.createDataFrame(left, "k string, at date, id long").repartition(4), spark.createDataFrame(right, "k string, since date, v double, s string")


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("backfill", [True, False])
def test_asof(sides, by, inclusive, backfill):
    left, right, l, r = sides  # noqa: E741
    out = asof_in_stretches(l, r.drop("k") if not by else r, by, "at", "since", ["v", "s"], inclusive=inclusive, backfill=backfill, stretch="month")
    assert out.columns == ["k", "at", "id", "v", "s"]
    got = {x.id: (x.v, x.s) for x in out.collect()}
    assert len(got) == len(left)
    for k, at, i in left:
        own = sorted((t, v, s) for key, t, v, s in right if t and (not by or key == k))
        past = [x for x in own if at and (x[0] <= at if inclusive else x[0] < at)]
        want = past[-1] if past else own[0] if backfill and own and at else None
        assert got[i] == (want[1:] if want else (None, None)), (k, at, i)


def test_no_nested_loop(sides):
    _, _, l, r = sides  # noqa: E741
    out = asof_join(l, r.drop("k"), [], "at", "since", ["v"], backfill=True)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in near_join(l, r, ["k"], "at", "since", 10, "left_anti")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("days", [0, 7, 45])
def test_near(sides, days):
    left, right, l, r = sides  # noqa: E741
    close = lambda k, at, x: at and x[1] and k == x[0] and abs((at - x[1]).days) <= days
    want = sorted((i, x[3]) for k, at, i in left for x in right if close(k, at, x))
    assert sorted((x.id, x.s) for x in near_join(l, r, ["k"], "at", "since", days).collect()) == want
    hit = {i for i, _ in want}
    assert {x.id for x in near_join(l, r, ["k"], "at", "since", days, "left_anti").collect()} == {i for *_, i in left} - hit
    assert sorted(x.id for x in near_join(l, r, ["k"], "at", "since", days, "left_semi").collect()) == sorted(hit)
