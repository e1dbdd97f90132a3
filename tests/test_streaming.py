"""Streaming jobs: reruns continue, repeats change nothing, late rows are dropped (ST01-ST03)."""

import datetime as dt

from plumbline.operators.snapshots import latest
from plumbline.sinks.tables import read_latest, write_changes
from plumbline.streaming import ingest

SCHEMA = "id bigint, ts timestamp, v string"


def _write(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_append_drops_repeats_and_late_rows(spark, tmp_path):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda: ingest.append_stream(ingest.new_rows(ingest.read_stream(spark, f"{src}/*", SCHEMA), "id", "ts", "1 day"), out, mark).awaitTermination()
    ids = lambda: sorted(r.id for r in spark.read.parquet(out).collect())
    _write(spark, src, [(1, _at(10), "a"), (2, _at(10), "b"), (1, _at(10), "a")], "b1")
    run()
    assert ids() == [1, 2]
    _write(spark, src, [(3, _at(20), "c"), (2, _at(10), "b")], "b2")
    run()
    assert ids() == [1, 2, 3]
    _write(spark, src, [(4, _at(2), "late"), (5, _at(21), "d")], "b3")
    run()
    assert ids() == [1, 2, 3, 5]
    run()
    assert ids() == [1, 2, 3, 5]


KEYED = (["id"], "v", "ts")


def test_upsert_keeps_the_latest(spark, tmp_path):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda: ingest.upsert_stream(ingest.read_stream(spark, f"{src}/*", SCHEMA), out, *KEYED, mark).awaitTermination()
    read = lambda: {(r.id, r.v) for r in read_latest(spark, out, SCHEMA, *KEYED).collect()}
    _write(spark, src, [(1, _at(1), "old"), (2, _at(1), "x")], "b1")
    run()
    _write(spark, src, [(1, _at(3), "new"), (2, _at(2), "")], "b2")
    run()
    assert read() == {(1, "new"), (2, "x")}
    # A late row of an old stamp comes out as what is latest, from the state.
    _write(spark, src, [(1, _at(2), "between"), (3, _at(1), "y")], "b3")
    run()
    assert read() == {(1, "new"), (2, "x"), (3, "y")}
    assert {(r.id, r.v) for r in spark.read.parquet(f"{out}/batch=2").collect()} == {(1, "new"), (3, "y")}


def test_the_order_of_batches_changes_nothing(spark, tmp_path):
    rows = [(i % 5, _at(1 + (i * 7) % 20), f"v{i}") for i in range(20)] + [(9, _at(3), "only"), (9, _at(4), " "), (8, _at(2), "a"), (8, _at(2), "b")]
    found = []
    for name, batches in (("one", [rows]), ("turned", [rows[::-1]]), ("many", [rows[i : i + 3] for i in range(0, len(rows), 3)]), ("late", [rows[12:], rows[:12]])):
        for n, batch in enumerate([*batches, batches[0]]):
            # The first batch comes again at the end.
            write_changes(spark.createDataFrame(batch, SCHEMA), str(tmp_path / name), n % len(batches), *KEYED)
        found.append(sorted(map(tuple, read_latest(spark, str(tmp_path / name), SCHEMA, *KEYED).collect())))
    assert len(found[0]) == 7 and found.count(found[0]) == len(found)


def test_the_stream_equals_the_batch_however_files_come(spark, tmp_path):
    rows = [(i % 7, _at(1 + (i * 5) % 20), f"v{i:02d}") for i in range(60)]
    want = sorted(map(tuple, latest(spark.createDataFrame(rows, SCHEMA), *KEYED).collect()))
    for name, order in (("along", range(0, 60, 10)), ("back", range(50, -1, -10))):
        src, out, mark = str(tmp_path / name), str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-mark")
        for k, at in enumerate(order):
            _write(spark, src, rows[at : at + 10], f"b{k}")
            ingest.upsert_stream(ingest.read_stream(spark, f"{src}/*", SCHEMA), out, *KEYED, mark).awaitTermination()
        assert sorted(map(tuple, read_latest(spark, out, SCHEMA, *KEYED).collect())) == want


def test_anomalies_go_to_their_own_table(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "n bigint, city string, state string"
    spark.createDataFrame([(1, "Reno", "NV"), (2, "reno ", "UT"), (3, "Atlantis", "ZZ"), (4, None, "NV")], schema).write.parquet(f"{src}/b1")
    gaz = spark.createDataFrame([("RENO", "NV")], "city string, state string")
    ingest.ingest_with_anomalies(ingest.read_stream(spark, f"{src}/*", schema), gaz, "city", "state", str(tmp_path / "rows"), str(tmp_path / "odd"), str(tmp_path / "mark")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4
    assert [(r.n, r.valid_states) for r in spark.read.parquet(str(tmp_path / "odd")).collect()] == [(2, "NV")]
