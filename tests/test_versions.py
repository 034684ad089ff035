"""Stored tables in months: what an upsert touches, what readers and other writers see."""

import datetime as dt

import pytest

from tickloom.sources import market as mk
from tickloom.sources import versions

SCHEMA = "ticker string, date date, close double"


@pytest.fixture
def bars(spark):
    def make(*rows):
        return spark.createDataFrame([(t, dt.date.fromisoformat(d) if d else None, float(x)) for t, d, x in rows], SCHEMA)

    return make


def rows(df):
    return sorted((r.ticker, str(r.date), r.close) for r in df.collect())


@pytest.fixture
def table(spark, bars, tmp_path):
    path = str(tmp_path / "t")
    mk.upsert_table(spark, path, bars(("A", "2024-01-30", 1), ("A", "2024-02-01", 2), ("B", "2024-03-05", 3)), SCHEMA)
    return path


def test_overlapping_days(spark, bars, tmp_path):
    """Stored 100, 101, 102 and new 999, 103, 104 that overlap on the third day: five rows, the third day new."""
    path = str(tmp_path / "t")
    mk.upsert_table(spark, path, bars(("A", "2024-01-01", 100), ("A", "2024-01-02", 101), ("A", "2024-01-03", 102)), SCHEMA)
    mk.upsert_table(spark, path, bars(("A", "2024-01-03", 999), ("A", "2024-01-04", 103), ("A", "2024-01-05", 104)), SCHEMA)
    assert [x for *_, x in rows(mk.read_bars(spark, path, schema=SCHEMA))] == [100, 101, 999, 103, 104]


def test_only_touched_months_change(spark, bars, table):
    before = versions.latest(spark, table)
    assert mk.upsert_table(spark, table, bars(("A", "2024-02-01", 9), ("C", "2024-02-02", 4)), SCHEMA) == ["2024-02"]
    after = versions.latest(spark, table)
    assert after.number == before.number + 1 and set(after.parts) == {"2024-01", "2024-02", "2024-03"}
    assert {m for m in after.parts if after.parts[m] != before.parts[m]} == {"2024-02"}
    assert rows(mk.read_bars(spark, table, schema=SCHEMA)) == [("A", "2024-01-30", 1), ("A", "2024-02-01", 9), ("B", "2024-03-05", 3), ("C", "2024-02-02", 4)]


def test_stored_rows_of_other_months_are_not_read(spark, bars, table, tmp_path):
    """Broken files of another month don't hinder an upsert, and limits of dates skip them."""
    place = tmp_path / "t" / versions.latest(spark, table).parts["2024-03"]
    for f in place.glob("part-*"):
        f.write_bytes(b"no parquet")
    for f in place.glob(".*.crc"):
        f.unlink()
    mk.upsert_table(spark, table, bars(("A", "2024-01-30", 7)), SCHEMA)
    assert rows(mk.read_bars(spark, table, end="2024-02-29", schema=SCHEMA)) == [("A", "2024-01-30", 7), ("A", "2024-02-01", 2)]
    assert len(mk.read_bars(spark, table, start="2024-02-01", end="2024-02-29", schema=SCHEMA).inputFiles()) == 1


def test_a_reader_sees_old_or_new(spark, bars, table, monkeypatch):
    """A reader that has begun keeps the old rows; one that begins before the manifest is out sees no part of the change."""
    begun, seen, plain = mk.read_bars(spark, table, schema=SCHEMA), [], versions.publish
    old = rows(begun)

    def slow(*args):
        seen.append(rows(mk.read_bars(spark, table, schema=SCHEMA)))
        return plain(*args)

    monkeypatch.setattr(versions, "publish", slow)
    mk.upsert_table(spark, table, bars(("A", "2024-01-30", 8), ("B", "2024-03-05", 8)), SCHEMA)
    assert seen == [old] and rows(begun) == old
    assert [x for *_, x in rows(mk.read_bars(spark, table, schema=SCHEMA))] == [8, 2, 8]


@pytest.mark.parametrize("other", ["2024-02-01", "2024-03-06"])
def test_two_writers_at_once(spark, bars, table, monkeypatch, other):
    """A writer that is overtaken, in the same month or in another, keeps the other's rows and its own."""
    plain, raced = versions.publish, []

    def overtaken(*args):
        if not raced:
            raced.append(True)
            mk.upsert_table(spark, table, bars(("Z", other, 50), ("A", "2024-02-01", 60)), SCHEMA)
        return plain(*args)

    monkeypatch.setattr(versions, "publish", overtaken)
    mk.upsert_table(spark, table, bars(("Z", other, 51), ("Y", "2024-01-01", 52)), SCHEMA)
    assert rows(mk.read_bars(spark, table, schema=SCHEMA)) == sorted([("A", "2024-01-30", 1), ("A", "2024-02-01", 60), ("B", "2024-03-05", 3), ("Z", other, 51), ("Y", "2024-01-01", 52)])


def test_a_replaced_table_tells_an_overtaken_writer(spark, bars, table):
    base = versions.latest(spark, table)
    assert mk.write_bars(bars(("A", "2024-05-01", 1)), table)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, table, base, {versions.WHOLE: "v-x"}, {})
    assert rows(mk.read_bars(spark, table, schema=SCHEMA)) == [("A", "2024-05-01", 1)]
    # the whole table is cut into months by its next upsert
    mk.upsert_table(spark, table, bars(("A", "2024-06-01", 2), ("N", None, 3)), SCHEMA)
    assert set(versions.latest(spark, table).parts) == {"2024-05", "2024-06", versions.NO_MONTH}
    assert rows(mk.read_bars(spark, table, schema=SCHEMA)) == [("A", "2024-05-01", 1), ("A", "2024-06-01", 2), ("N", "None", 3)]


def test_old_versions_go_and_unknown_folders_stay(spark, bars, table, tmp_path):
    at_work = tmp_path / "t" / "v-someone"
    at_work.mkdir()
    for x in range(4):
        mk.upsert_table(spark, table, bars(("A", "2024-01-30", x)), SCHEMA)
    named = {f.split("/")[0] for n in versions._numbers(spark, table) for f in versions._read(spark, table, n).parts.values()}
    assert {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")} == named | {"v-someone"}
    assert len(versions._numbers(spark, table)) == versions.KEPT


def test_update_of_all_securities(spark, bars, table):
    landed = spark.createDataFrame([("A", "2024-02-01", "5"), ("B", "2024-03-06", "n/a"), ("B", "2024-03-07", "6")], "ticker string, date string, close string")
    failed = mk.update_table(spark, table, landed, SCHEMA)
    assert [(r.ticker, r.failures) for r in failed.collect()] == [("B", 1)]
    assert rows(mk.read_bars(spark, table, schema=SCHEMA)) == [("A", "2024-01-30", 1), ("A", "2024-02-01", 5), ("B", "2024-03-05", 3)]


def test_keys_must_hold_the_date(spark, bars, table):
    with pytest.raises(ValueError, match="date"):
        mk.upsert_table(spark, table, bars(("A", "2024-01-30", 1)), SCHEMA, keys=("ticker",))
