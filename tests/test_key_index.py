from datetime import timedelta

import pytest
from helpers import T0, frame, rows_of, trip
from pyspark.sql import functions as F

from tripweave.sources import key_index, tables
from tripweave.sources.notes import read_note

DAY = timedelta(days=1)


def warehouse(spark, path, days=6, per_day=10):
    rows = [trip(f"d{d}-{i}", T0 + d * DAY) for d in range(days) for i in range(per_day)]
    tables.upsert_table(frame(spark, rows), path)
    return rows


def later(ride, days, hours=1, fare=99.0):
    return trip(ride, T0 + days * DAY, ingest=T0 + timedelta(days=100, hours=hours), fare=fare)


def places(spark, path):
    return {r.ride_id: (r.event_date.isoformat(), r.fare_usd) for r in tables.read_table(spark, path).collect()}


def spoil(path, day):
    """Make the files of a date unreadable."""
    for file in (path / f"event_date={day}").glob("*.parquet"):
        file.write_bytes(b"not parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_an_upsert_reads_candidate_dates_only(spark, tmp_path):
    path = tmp_path / "wh"
    warehouse(spark, str(path))
    before = places(spark, str(path))
    for day in ("2024-01-11", "2024-01-12", "2024-01-13"):
        spoil(path, day)
    # From the 14th to the 15th; a new trip; one that stays.
    tables.upsert_table(frame(spark, [later("d4-3", 5), later("new", 0), later("d0-1", 0)]), str(path))
    held = tables.read_table(spark, str(path)).where(F.col("event_date").isin("2024-01-10", "2024-01-14", "2024-01-15"))
    got = {r.ride_id: r.event_date.isoformat() for r in held.collect()}
    want = {k: d for k, (d, _) in before.items() if d in ("2024-01-10", "2024-01-14", "2024-01-15")} | {"d4-3": "2024-01-15", "new": "2024-01-10"}
    assert got == want


def test_keys_are_found_after_many_moves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 8)
    path = str(tmp_path / "wh")
    want = {r[0]: (r[1].date().isoformat(), r[7]) for r in warehouse(spark, path, 3, 12)}
    for step in range(1, 7):
        moved = [later(f"d{step % 3}-{i}", (step * i) % 8, hours=step, fare=float(step)) for i in range(step % 4 + 1)]
        tables.upsert_table(frame(spark, moved), path)
        want |= {r[0]: (r[1].date().isoformat(), r[7]) for r in moved}
        assert places(spark, path) == want
    runs = read_note(spark, path, "key-runs-ride_id")
    assert max(r["buckets"] for r in runs) > 1
    sizes = [r["keys"] for r in runs]
    assert all(a > key_index.GROWTH * b for a, b in zip(sizes, sizes[1:]))
    found = key_index.dates_of(frame(spark, [trip("d0-0"), trip("nowhere")]), path, "ride_id")
    assert want["d0-0"][0] in {r.date for r in found.collect()}


def test_keys_that_do_not_move_need_no_index_and_one_is_made_when_they_do(spark, tmp_path):
    path = str(tmp_path / "wh")
    tables.upsert_table(frame(spark, [trip("a", T0), trip("b", T0 + DAY)]), path, keys_move=False)
    assert not key_index.exists(spark, path, "ride_id")
    tables.upsert_table(frame(spark, [later("a", 3)]), path)
    assert key_index.exists(spark, path, "ride_id")
    tables.upsert_table(frame(spark, [later("c", 5)]), path, keys_move=False)  # the index is kept up here too
    tables.upsert_table(frame(spark, [later("c", 6, hours=2), later("a", 3, hours=2)]), path)
    assert {k: d for k, (d, _) in places(spark, path).items()} == {"a": "2024-01-13", "b": "2024-01-11", "c": "2024-01-16"}


def test_trips_without_date_or_key(spark, tmp_path):
    path = str(tmp_path / "wh")
    undated = frame(spark, [trip("a", T0)]).withColumn("event_time", F.lit(None).cast("timestamp"))
    tables.upsert_table(frame(spark, [trip(None, T0), trip(None, T0, fare=1.0)]).unionByName(undated), path)
    tables.upsert_table(frame(spark, [later("a", 2), trip(None, T0)]), path)
    got = rows_of(tables.read_table(spark, path).select("ride_id", F.col("event_date").cast("string"), "fare_usd"))
    assert got == sorted([("a", "2024-01-12", 99.0), (None, "2024-01-10", 10.0), (None, "2024-01-10", 1.0)], key=repr)


def test_a_merge_that_died_is_finished_with_its_index(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "wh")
    warehouse(spark, path, 2, 3)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(key_index, "add_run", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        tables.upsert_table(frame(spark, [later("d0-0", 5)]), path)
    tables.upsert_table(frame(spark, [later("d0-0", 7, hours=2)]), path)
    assert places(spark, path)["d0-0"][0] == "2024-01-17"
    assert tables.read_table(spark, path).count() == 6
    assert read_note(spark, path, "journal") is None


def test_a_range_is_replaced(spark, tmp_path):
    path = str(tmp_path / "wh")
    warehouse(spark, path, 4, 5)
    only = [later("d1-0", 1), later("d3-4", 2, fare=5.0)]
    instead = (T0 + DAY, T0 + 3 * DAY)
    for _ in range(2):
        tables.upsert_table(frame(spark, only), path, instead_of=instead)
        got = places(spark, path)
        want = {f"d0-{i}": "2024-01-10" for i in range(5)} | {f"d3-{i}": "2024-01-13" for i in range(4)} | {"d1-0": "2024-01-11", "d3-4": "2024-01-12"}
        assert {k: d for k, (d, _) in got.items()} == want
    tables.upsert_table(frame(spark, []), path, instead_of=(T0, T0 + 9 * DAY))
    assert tables.read_table(spark, path).count() == 0
