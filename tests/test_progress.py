"""When a bounded read ends, and sums over all micro-batches."""

import threading
import time

import pytest

from tests.rows import event, text
from tillmart.sources import json_files
from tillmart.sources.messages import decode, strict
from tillmart.streaming import daily, ingest, progress

BATCH = event()["batch_id"]


def deliver(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    part = folder / f".{name}"
    part.write_text("\n".join(map(text, documents)))
    part.rename(folder / name)


def read(spark, tmp_path, announced, **bounds):
    targets = ingest.Targets.below(f"{tmp_path}/lake")
    topic = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "topic"))
    return targets, ingest.ingest_batch(topic, targets, f"{tmp_path}/checkpoint", BATCH, announced, **bounds)


def test_ends_at_the_announced_count(spark, tmp_path):
    deliver(tmp_path / "topic", "1.txt", event(1), event(2, batch_id="other"))
    deliver(tmp_path / "topic", "2.txt", event(3), event(4))

    def later():
        time.sleep(6)
        deliver(tmp_path / "topic", "3.txt", event(5))

    threading.Thread(target=later).start()
    targets, outcome = read(spark, tmp_path, 4, idle=60, total=90)
    assert (outcome.reason, outcome.wanted, outcome.rows, outcome.micro_batches) == (progress.ANNOUNCED, 4, 5, 3)
    assert json_files.read_raw_batch(spark, targets.raw, BATCH).count() == 4


def test_ends_when_nothing_comes_or_time_is_over(spark, tmp_path):
    deliver(tmp_path / "topic", "1.txt", event(1))
    started = time.monotonic()
    _, outcome = read(spark, tmp_path, 2, idle=4, total=90)
    assert (outcome.reason, outcome.wanted) == (progress.IDLE, 1) and time.monotonic() - started < 60
    stop = threading.Event()

    def go_on():
        n = 2
        while not stop.wait(0.5):
            deliver(tmp_path / "topic", f"{n}.txt", event(n, batch_id="other"))
            n += 1

    thread = threading.Thread(target=go_on)
    thread.start()
    try:
        _, outcome = read(spark, tmp_path, 2, idle=30, total=8)
    finally:
        stop.set()
        thread.join()
    assert (outcome.reason, outcome.wanted) == (progress.TIME, 0) and outcome.rows > 0


def test_a_long_micro_batch_is_not_idle(spark, tmp_path):
    """Its events come at once and take longer than the idle time to write; then none come any more."""
    deliver(tmp_path / "topic", "1.txt", event(1), event(2))
    topic = spark.readStream.text(str(tmp_path / "topic"))
    written = []

    def slow(batch, number):
        time.sleep(8)
        written.append(batch.count())

    for announced, reason in ((2, progress.ANNOUNCED), (3, progress.IDLE)):
        progress.TALLY.listen(spark)
        counted = progress.awaited(topic, topic["value"].contains(BATCH))
        query = counted.writeStream.foreachBatch(slow).option("checkpointLocation", f"{tmp_path}/{announced}").trigger(processingTime="0 seconds").start()
        outcome = progress.end_when(query, announced, idle=3, total=90)
        assert (outcome.reason, outcome.wanted, outcome.rows) == (reason, 2, 2)
    assert written == [2, 2]


def test_more_than_a_hundred_micro_batches(spark, tmp_path):
    for n in range(104):
        deliver(tmp_path / "topic", f"{n}.txt", event(n))
    topic = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "topic"))
    progress.TALLY.listen(spark)
    counted = progress.awaited(topic, topic["value"].contains(BATCH))
    query = counted.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(processingTime="0 seconds").start()
    outcome = progress.end_when(query, 104, idle=60, total=300)
    assert (outcome.reason, outcome.wanted, outcome.micro_batches) == (progress.ANNOUNCED, 104, 104)


def test_late_rows_of_forgotten_micro_batches(spark, tmp_path):
    """The query remembers two micro-batches only; the late receipts came in an earlier one."""
    stamps = ["2026-07-10", "2026-07-20", "2026-07-01", "2026-07-20", "2026-07-21", "2026-07-22", "2026-07-23"]
    for n, day in enumerate(stamps):
        deliver(tmp_path / "topic", f"{n}.txt", event(n, timestamp=f"{day}T10:00:00"))
        time.sleep(0.02)
    names = {"spark.sql.streaming.numRecentProgressUpdates": "2", "spark.sql.shuffle.partitions": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        topic = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "topic"))
        measured = daily.daily_sales(daily.receipt_measures(strict(decode(topic))))
        query = daily.maintain(measured, f"{tmp_path}/days", f"{tmp_path}/checkpoint")
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(query.recentProgress) <= 2
    assert daily.late_rows(query) == 1
    with pytest.raises(ValueError, match="1 rows came later"):
        daily.require_none_late(query)


def test_a_failing_query_raises(spark, tmp_path):
    progress.TALLY.listen(spark)
    deliver(tmp_path / "topic", "1.txt", event(1))
    topic = spark.readStream.text(str(tmp_path / "topic"))

    def fails(batch, number):
        raise RuntimeError("lost sink")

    query = topic.writeStream.foreachBatch(fails).option("checkpointLocation", f"{tmp_path}/checkpoint").start()
    with pytest.raises(Exception, match="lost sink"):
        progress.end_when(query, 1, idle=60, total=60)
