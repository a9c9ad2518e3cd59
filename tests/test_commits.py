"""Two writers of one table of periods."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from sensorwatch.schemas import table
from sensorwatch.sources.commits import PeriodTable

SCHEMA = table("year int, week int, v double")


def weeks(spark, *numbers, v=1.0):
    return spark.createDataFrame([(2024, n, v) for n in numbers], SCHEMA)


def held(history):
    return sorted((r["week"], r["v"]) for r in history.read().collect())


def test_interleaved_writers_of_one_period(spark, folder):
    history = PeriodTable(spark, folder, SCHEMA, ["year", "week"])
    assert held(history) == []
    one, two = history.prepare(weeks(spark, 1, 2)), history.prepare(weeks(spark, 2, 3, v=2.0))
    assert held(history) == []
    assert history.commit(two) and not history.commit(one)
    assert held(history) == [(2, 2.0), (3, 2.0)]
    assert not history.append(weeks(spark, 1, 2))
    assert history.append(weeks(spark, 1, 2), "skip_rows")
    assert held(history) == [(1, 1.0), (2, 2.0), (3, 2.0)]
    assert not history.append(weeks(spark, 1, 2, 3), "skip_rows") and not history.append(weeks(spark))


def test_rows_without_a_manifest_are_not_read(spark, folder):
    history = PeriodTable(spark, folder, SCHEMA, ["year", "week"])
    assert history.prepare(weeks(spark, 5)) and held(history) == []
    assert history.append(weeks(spark, 5, v=3.0)) and held(history) == [(5, 3.0)]
    assert len(list(Path(folder, "rows").iterdir())) == 2 and len([p for p in Path(folder, "manifests").iterdir() if p.suffix == ".json"]) == 1


def test_writers_at_once_add_each_week_once(spark, folder):
    """Four threads, overlapping weeks: each week is there once, whoever was first."""
    history = PeriodTable(spark, folder, SCHEMA, ["year", "week"])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: history.append(weeks(spark, *range(k, k + 4), v=float(k)), "skip_rows"), range(4)))
    assert [w for w, _ in held(history)] == list(range(7))
