"""Path tables with a log: replacements without a gap, batches added once,
compaction, ids, and exactly-once appends to catalog tables."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from quarry.operators import clean as CL
from quarry.session import scratch_path
from quarry.sources import events as EV
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data
from quarry.sources.tablelog import TableLog

from conftest import SF_SMALL


def numbers(spark, start, n=10):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).alias("x"))


def folders(log):
    return {n for n, _ in log.files.names(log.table + "/_parts")}


def test_no_reader_finds_the_table_missing(spark):
    target = scratch_path(spark, "replaced")
    TB.replace_table(numbers(spark, 0), target)
    stop, seen, wrong = threading.Event(), set(), []

    def poll():
        while not stop.is_set():
            try:
                rows = sorted(r.id for r in TB.scan(spark, target).collect())
                assert rows == list(range(rows[0], rows[0] + 10)) and rows[0] % 100 == 0
                seen.add(rows[0])
            except Exception as e:  # noqa: BLE001  any failure of a reader counts
                wrong.append(repr(e))

    t = threading.Thread(target=poll)
    t.start()
    try:
        for i in range(1, 21):
            TB.replace_table(numbers(spark, 100 * i), target)
    finally:
        stop.set()
        t.join()
    assert not wrong and len(seen) > 2
    assert TB.scan(spark, target).agg(F.min("id")).first()[0] == 2000


@pytest.mark.parametrize("step", ["write", "create"])
def test_a_failed_replacement_keeps_the_old_rows(spark, monkeypatch, step):
    target = scratch_path(spark, "kept")
    TB.replace_table(numbers(spark, 0), target)

    def lost(*args, **kw):
        raise OSError("lost")

    owner = TableLog if step == "write" else type(TableLog(spark, target).files)
    monkeypatch.setattr(owner, step, lost)
    with pytest.raises(OSError):
        TB.replace_table(numbers(spark, 100), target)
    monkeypatch.undo()
    assert TB.scan(spark, target).agg(F.max("id")).first()[0] == 9
    TB.replace_table(numbers(spark, 100), target)
    assert TB.scan(spark, target).agg(F.max("id")).first()[0] == 109


def test_replacing_changes_rows_and_schema_and_keeps_recent_files(spark):
    target = scratch_path(spark, "schema")
    TB.replace_table(numbers(spark, 0), target)
    before = TB.scan(spark, target)
    TB.replace_table(spark.createDataFrame([("a",)], "name string"), target)
    assert TB.scan(spark, target).columns == ["name"]
    assert before.count() == 10  # a reader that began before the switch
    TB.replace_table(numbers(spark, 0).limit(0), target, keep_seconds=0)
    assert TB.scan(spark, target).columns == ["id", "x"] and TB.scan(spark, target).count() == 0
    assert folders(TableLog(spark, target)) == set()


def test_a_plain_folder_becomes_a_table_with_a_log(spark):
    target = scratch_path(spark, "plain")
    numbers(spark, 0).write.parquet(target)
    assert TB.scan(spark, target).count() == 10
    TB.append_table(numbers(spark, 10), target)
    assert spark.read.parquet(target).count() == 20
    TB.replace_table(numbers(spark, 50), target)
    assert sorted(r.id for r in TB.scan(spark, target).collect()) == list(range(50, 60))
    assert not [n for n, _ in TableLog(spark, target).files.names(target) if not n.startswith((".", "_"))]


def test_writers_that_meet_lose_nothing(spark):
    target, errors = scratch_path(spark, "race"), []

    def add(i):
        try:
            TB.append_table(numbers(spark, 100 * i), target)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert TB.scan(spark, target).count() == TB.scan(spark, target).distinct().count() == 80


def test_many_batches_leave_few_folders_and_replays_change_nothing(spark):
    log = TableLog(spark, scratch_path(spark, "batches"))
    n, fan_in = 500, 16
    one = numbers(spark, 0, 1).coalesce(1)
    for b in range(n):
        assert log.append(one.withColumn("id", F.lit(b).cast("long")), "w", b, keep_seconds=0)
        log.compact(fan_in, keep_seconds=0)
    state = log.state()
    assert state["covered"] == {"w": [[0, n - 1]]}
    assert len(state["parts"]) <= 3 * (fan_in - 1) and folders(log) == {p["dir"] for p in state["parts"]}
    assert len(log.files.names(log.table + "/_log")) <= 25  # versions and their checksums
    for b in (0, 17, 255, n - 1):
        assert not log.append(one, "w", b)
    assert log.state() == state
    assert sorted(r.id for r in log.scan().collect()) == list(range(n))
    assert log.append(one, "another", 0)


def test_compaction_of_a_table_that_changes_meanwhile(spark, monkeypatch):
    log = TableLog(spark, scratch_path(spark, "meanwhile"))
    for b in range(4):
        log.append(numbers(spark, 10 * b), "w", b)
    write = TableLog.write

    def replaced_meanwhile(self, df, level=0):
        part = write(self, df, level)
        if level:
            monkeypatch.setattr(TableLog, "write", write)
            TableLog(spark, log.table).replace(numbers(spark, 900))
        return part

    monkeypatch.setattr(TableLog, "write", replaced_meanwhile)
    log.compact(fan_in=4)
    assert sorted(r.id for r in log.scan().collect()) == list(range(900, 910))


def test_appended_rows_get_fresh_ids(spark):
    """Decoded rows have no id; rows that bring their own move the counter on."""
    target = scratch_path(spark, "raw_data")
    good, _ = EV.quarantine_bad_rows(EV.decode_events(EV.event_feed(raw_data(spark, SF_SMALL)).select("value")))
    TB.create_raw_table(spark, target)
    TB.create_raw_table(spark, target)
    assert TB.append_raw(good, target)
    assert TB.append_raw(raw_data(spark, SF_SMALL), target)
    assert TB.append_raw(good, target, batch_id=3)
    assert not TB.append_raw(good, target, batch_id=3)
    rows = TB.scan(spark, target)
    assert rows.columns == raw_data(spark, SF_SMALL).columns
    assert rows.count() == 2 * good.count() + raw_data(spark, SF_SMALL).count()
    assert rows.where("id is null").count() == 0
    own = raw_data(spark, SF_SMALL).agg(F.max("id")).first()[0]
    assert rows.where(F.col("id") > own).count() == good.count()


def test_batches_go_to_a_catalog_table_once(spark, monkeypatch):
    """Also where a try broke off within the append, or just after it."""
    name, ledger = f"landing_{uuid.uuid4().hex[:8]}", scratch_path(spark, "ledger")
    good, _ = EV.quarantine_bad_rows(EV.decode_events(EV.event_feed(raw_data(spark, SF_SMALL)).select("value")))
    TB.create_raw_table(spark, name)
    numbered = raw_data(spark, SF_SMALL).where("id < 50")
    TB.append_table(numbered, name)  # rows from before the ledger
    had = numbered.count()
    try:
        assert TB.append_raw(good, name, batch_id=0, ledger=ledger)
        assert not TB.append_raw(good, name, batch_id=0, ledger=ledger)
        whole = TB._write

        def part_of_it(df, target, mode, fmt="parquet", **options):
            whole(df.where("id % 2 = 0"), target, mode, fmt, **options)
            raise OSError("lost within the append")

        monkeypatch.setattr(TB, "_write", part_of_it)
        with pytest.raises(OSError):
            TB.append_raw(good, name, batch_id=1, ledger=ledger)
        monkeypatch.setattr(TB, "_write", whole)
        spark.catalog.refreshTable(name)
        monkeypatch.setattr(TableLog, "cover", lambda *a: (_ for _ in ()).throw(OSError("lost after the append")))
        with pytest.raises(OSError):
            TB.append_raw(good, name, batch_id=1, ledger=ledger)
        monkeypatch.undo()
        assert TB.append_raw(good, name, batch_id=1, ledger=ledger)
        rows = spark.table(name)
        assert rows.count() == had + 2 * good.count() == rows.select("id").distinct().count()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_a_catalog_table_is_switched_to_its_new_location(spark):
    name = f"switched_{uuid.uuid4().hex[:8]}"
    try:
        for i in range(4):
            TB.replace_table(numbers(spark, 100 * i), name)
            assert sorted(r.id for r in TB.scan(spark, name).collect()) == list(range(100 * i, 100 * i + 10))
        TB.replace_table(spark.createDataFrame([("a",)], "name string"), name)
        assert TB.scan(spark, name).columns == ["name"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_clean_table_reads_with_pushed_filters(spark):
    target = scratch_path(spark, "cleaned")
    TB.replace_table(CL.clean_events(raw_data(spark, SF_SMALL)), target)
    plan = TB.scan(spark, target).where("price > 100").select("city")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(price,100)" in plan and "ReadSchema: struct<price:bigint,city:string>" in plan
