"""Round trips through readers and writers keep all columns of the trips and the rides."""

import pytest

from cabrank.registry import storage_queries as q
from cabrank.sources import storage


def same(found, expected):
    assert set(found.columns) == set(expected.columns) and len(expected.columns) > 20
    found = found.select(expected.columns)
    assert dict(found.dtypes) == dict(expected.dtypes)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


@pytest.mark.parametrize("call", [q.table_or_fallback, q.partitioned_round_trip])
def test_trips(bound, call):
    same(call(bound), bound.trips)


def test_combined_sample(bound):
    found = q.combined_sample(bound)
    expected = storage.first_rows(q._zoned(q.wide(bound.trips)))
    same(found.drop("written_rows"), expected)
    assert {r[0] for r in found.select("written_rows").collect()} == {bound.trips.count()}


def test_rides(bound):
    same(q.json_round_trip(bound), bound.rides)


def test_a_repeated_load_does_not_join_its_source_again(bound, monkeypatch):
    plans, load = [], storage.load_verified

    def spied(df, path):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return load(df, path)

    monkeypatch.setattr(storage, "load_verified", spied)
    found = q.load_and_verify(bound).collect()
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)
    assert [(r.failed_batches, r.checked_rows) for r in found] == [(0, bound.trips_all.count())]
