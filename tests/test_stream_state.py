"""State across micro-batches: epoch folders, windowed rates, repeated keys."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from sluice.specs import TableSpec
from sluice.streaming.bronze_stream import stream_ingest_csv, stream_ingest_with_quality
from sluice.streaming.epochs import EpochStore, KeyState
from sluice.streaming.windows import WindowRates

from helpers import rows

RUNS = "run_id int, status string, started_at timestamp_ntz"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_an_epoch_written_again_replaces_its_rows(spark, tmp_path):
    store = EpochStore(spark, f"{tmp_path}/s", "a int, b string")
    frame = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "a int, b string")
    assert store.read().count() == 0
    store.put(frame(1, 2), 0)
    store.put(frame(3), 1)
    store.put(frame(), 1)  # the replay found nothing: what it wrote before goes
    store.put(frame(4), 2)
    assert rows(store.read()) == [(1, "x", 0), (2, "x", 0), (4, "x", 2)]
    assert rows(store.read(before=2).select("a")) == [(1,), (2,)]
    again = EpochStore(spark, f"{tmp_path}/s", "a int, b string")
    assert again.read().count() == 3


def test_compaction_keeps_the_sums(spark, tmp_path):
    store = EpochStore(spark, f"{tmp_path}/s", "k string, n long")
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    for epoch in range(7):
        store.put(spark.createDataFrame([("a", epoch), ("b", 1)], "k string, n long"), epoch)
        store.compact(epoch, merge, every=3)
        expected = [("a", sum(range(epoch + 1))), ("b", epoch + 1)]
        assert rows(merge(store.read())) == expected
    assert store.read().count() == 2 + 2  # epochs 0 to 5 merged at epoch 6, which has its own
    store.put(spark.createDataFrame([("a", 100)], "k string, n long"), 6)
    assert rows(merge(store.read())) == [("a", 115), ("b", 6)]


def arrivals(spark, path, *files):
    """Each list of runs as one file; files come in this order."""
    for i, runs in enumerate(files):
        name = f"{path}/f{len(glob.glob(f'{path}/f*'))}"
        spark.createDataFrame(runs, RUNS).coalesce(1).write.parquet(name)
        for part in glob.glob(f"{name}/*.parquet"):
            os.utime(part, (1_700_000_000 + 10 * (len(glob.glob(f"{path}/f*")) + i),) * 2)
    schema = spark.createDataFrame([], RUNS).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(str(path))


def test_windows_late_rows_and_rows_without_a_time(spark, tmp_path):
    stream = arrivals(spark, tmp_path / "in",
                      [(1, "success", at(0, 5)), (2, "failed", at(3, 0)), (3, "success", None)],
                      [(4, "success", at(2, 40)), (5, "failed", at(0, 10)), (6, None, at(3, 59))],
                      [(7, "success", at(9, 0)), (8, "success", at(2, 59))])
    rates = WindowRates(spark, stream.schema, "1 hour", "30 minutes", folder=f"{tmp_path}/w")
    rates.run(stream)
    # after the first file the mark is 02:30: window 0 is closed, window 2 isn't; after the second it is 03:29
    got = rows(rates.series().select(F.hour("window_start"), "runs", "succeeded", "success_rate", "closed"))
    assert got == [(0, 1, 1, 100.0, True), (2, 1, 1, 100.0, True), (3, 2, 0, 0.0, True), (9, 1, 1, 100.0, False)]
    side = rows(rates.side_rows().select("run_id", F.hour("window_start"), "reason"))
    assert side == [(3, None, "no time"), (5, 0, "late"), (8, 2, "late")]
    assert rates.mark() == at(8, 30)


def test_a_replayed_micro_batch_counts_once(spark, tmp_path):
    stream = arrivals(spark, tmp_path / "in", [(1, "success", at(0)), (2, "failed", at(5))], [(3, "success", at(0, 1)), (4, "success", at(5, 1))])
    rates = WindowRates(spark, stream.schema, "1 hour", "10 minutes", folder=f"{tmp_path}/w")

    class Lost(Exception):
        pass

    def dies(batch, epoch):  # the driver is lost after the states of epoch 1 were written, before Spark commits it
        rates.merge_batch(batch, epoch)
        if epoch == 1:
            raise Lost

    with pytest.raises(Exception, match="Lost"):
        rates.run(stream, on_batch=dies)
    before = (rows(rates.series()), rows(rates.side_rows()))
    seen = []
    again = WindowRates(spark, stream.schema, "1 hour", "10 minutes", folder=f"{tmp_path}/w")
    again.run(stream, on_batch=lambda b, e: (seen.append(e), again.merge_batch(b, e)))
    assert seen == [1]
    assert (rows(again.series()), rows(again.side_rows())) == before
    assert rows(again.series().select("runs", "succeeded")) == [(1, 1), (2, 1)]
    more = arrivals(spark, tmp_path / "in", [(5, "failed", at(5, 30))])
    again.run(more)
    assert rows(again.series().select("runs", "succeeded")) == [(1, 1), (3, 1)]


def test_an_empty_stream_has_no_windows(spark, tmp_path):
    stream = arrivals(spark, tmp_path / "in", [])
    rates = WindowRates(spark, stream.schema, folder=f"{tmp_path}/w")
    rates.run(stream)
    assert rates.mark() is None and rates.series().count() == 0 == rates.side_rows().count()


def test_keys_of_earlier_batches(spark, tmp_path):
    state = KeyState(spark, f"{tmp_path}/k", ["a", "b c"])
    frame = lambda *r: spark.createDataFrame(r, "a string, `b c` string")
    assert state.known(frame(("x", "y")), 0) == 0
    state.accept(frame(("x", "y"), ("x", "y"), ("ab", None), (None, None)), 0)
    assert state.known(frame(("x", "y"), ("x", "y"), ("a", "b"), (None, "ab")), 1) == 1
    assert state.known(frame((None, None), ("ab", None)), 1) == 2
    assert state.known(frame(("x", "y")), 0) == 0  # a replay of batch 0 doesn't meet its own keys


def test_a_key_repeated_in_a_later_batch_is_gated(spark, tmp_path):
    schema = "id int, v string"
    places = dict(output=f"{tmp_path}/o", reports=f"{tmp_path}/r", checkpoint=f"{tmp_path}/c", as_of=dt.datetime(2024, 1, 1))
    src = tmp_path / "in"

    def arrive(n, *ids):
        spark.createDataFrame([(i, "x") for i in ids], schema).write.parquet(str(src / f"p{n}"))
        return stream_ingest_with_quality(spark, f"{src}/*", spark.createDataFrame([], schema).schema, TableSpec("T", key=("id",)), **places)

    arrive(0, 1, 2, 3)
    got, reports = arrive(1, 3, 4)  # 3 came before: the whole batch is blocked
    assert rows(got.select("id")) == [(1,), (2,), (3,)]
    got, reports = arrive(2, 4, 5)  # 4 was never let in
    assert rows(got.select("id")) == [(1,), (2,), (3,), (4,), (5,)]
    key = reports.filter("check_name = 'key_unique'").select("batch_id", "metric", "passed")
    assert rows(key) == [(0, 0.0, True), (1, 1.0, False), (2, 0.0, True)]


def test_csv_stream_gates_a_key_of_an_earlier_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i, text in enumerate(["id,v\n1,x\n2,y\n", "id,v\n2,z\n3,z\n", "id,v\n4,z\n"]):
        (src / f"{i}.csv").write_text(text)
        os.utime(src / f"{i}.csv", (1_700_000_000 + 10 * i,) * 2)
    got, reports, bad = stream_ingest_csv(spark, str(src), ["id", "v"], TableSpec("T", key=("id",)), output=f"{tmp_path}/o",
                                          reports=f"{tmp_path}/r", quarantine_root=f"{tmp_path}/q", checkpoint=f"{tmp_path}/c",
                                          as_of=dt.datetime(2024, 1, 1), max_files_per_trigger=1)
    assert rows(got.select("id")) == [("1",), ("2",), ("4",)] and bad.count() == 0
    assert rows(reports.filter("check_name = 'key_unique' AND NOT passed").select("batch_id", "metric")) == [(1, 1.0)]
