"""Tables that compress well, or came in one row group, keep all tasks busy; so do arrivals of a
stream and the moves of a commit."""

import threading
from collections import Counter

import pytest

from eventlake.plans import catalog, fixtures as fx
from eventlake.session import configure_session
from eventlake.sinks import commits

ROWS = 240


@pytest.fixture()
def sf(spark, tmp_path, monkeypatch):
    """240 events of one hour in one file of one row group."""
    configure_session(spark)
    spark.range(ROWS).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-15 14:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 7 AS user_id",
        "element_at(array('purchase', 'click', 'view', 'signup', 'error'), CAST(id % 5 AS INT) + 1) AS event_type",
        "id / 2 AS value", "concat('{\"k\": ', id, '}') AS props").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(fx, "ROWS_PER_TASK", 10, raising=False)
    return str(tmp_path)


def test_rows_of_one_row_group_go_to_many_tasks(spark, sf):
    events = fx.load(spark, sf, "events")
    sizes = [len(part) for part in events.rdd.glom().collect()]
    assert len(sizes) == ROWS // 10 and max(sizes) < ROWS / 4
    assert Counter(events.collect()) == Counter(spark.read.parquet(f"{sf}/events.parquet").collect())


def test_a_table_for_one_task_is_not_shuffled(spark, sf, monkeypatch):
    monkeypatch.setattr(fx, "ROWS_PER_TASK", ROWS)
    assert "Exchange" not in fx.load(spark, sf, "events")._jdf.queryExecution().executedPlan().toString()


def test_an_arrival_is_written_by_several_tasks(spark, sf, monkeypatch):
    written, write = [], catalog.write_jsonl
    monkeypatch.setattr(catalog, "write_jsonl", lambda df, path: (write(df, path), written.append(len(spark.read.text(path).inputFiles()))))
    runs = catalog.t5_restarted_run(spark, sf).collect()
    assert written == [8, 8, 8] and runs == [(3, ROWS, runs[0].written, ROWS - runs[0].written)]
    written.clear()
    assert catalog.t1_count_or_time(spark, sf).collect() == [(3, ROWS, True, ROWS)]
    assert written == [3] * catalog.T1_ARRIVALS


def test_a_commit_moves_its_files_side_by_side(spark, tmp_path, monkeypatch):
    lake, fs_path, movers = str(tmp_path / "lake"), commits._fs_path, set()
    started = threading.Barrier(2)
    spark.range(40).selectExpr("id", "id % 20 AS part").write.partitionBy("part").parquet(commits.staging_folder(lake, "a"))

    def seen(session, place):
        if "/part=" in place and place.endswith(".parquet") and not movers.issuperset({threading.get_ident()}):
            movers.add(threading.get_ident())
            if len(movers) <= 2:
                started.wait(60)  # breaks if one thread makes all moves
        return fs_path(session, place)

    monkeypatch.setattr(commits, "_fs_path", seen)
    commits.commit(spark, lake, "a", [lake], {"writer": "w", "batch": 0, "upto": 0})
    assert len(movers) > 1
    assert Counter(r.id for r in spark.read.parquet(lake).collect()) == Counter(range(40))
