"""A batch that is repeated after a failure adds nothing."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aeroline.schemas import READING
from aeroline.sources.event_readings import feed_records, raw_readings
from aeroline.streaming import once
from tests.conftest import SF_DIR, rows

MESSAGES = "key STRING, value STRING"


def lose_last_commit(checkpoint):
    commits = sorted((p for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for path in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        path.unlink(missing_ok=True)
    return int(commits[-1].name)


def drain(spark, tmp_path, **options):
    stream = spark.readStream.schema(MESSAGES).options(maxFilesPerTrigger=1, **options).json(f"{tmp_path}/in")
    once.messages_to_quarantine(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out") if Path(f"{tmp_path}/out").exists() else None


def deliver(spark, tmp_path, *values):
    spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], MESSAGES).coalesce(1).write.mode("append").json(f"{tmp_path}/in")


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    deliver(spark, tmp_path, "{}", "broken", "broken")
    deliver(spark, tmp_path, "[1]", "{broken")
    assert rows(drain(spark, tmp_path).groupBy("value").count()) == [("[1]", 1), ("broken", 2), ("{broken", 1)]
    number = lose_last_commit(f"{tmp_path}/checkpoint")
    ledger = lambda: rows(once.batches(spark, f"{tmp_path}/out"))
    before = ledger()
    assert number == 1 and [r[:2] for r in before] == [("broken", 0), ("broken", 1)] and sum(r[2] for r in before) == 4
    assert drain(spark, tmp_path).count() == 4 and ledger() == before
    deliver(spark, tmp_path, "more", "{}")
    assert drain(spark, tmp_path).count() == 5 and len(ledger()) == 3
    assert once.read_appended(spark, f"{tmp_path}/out").columns == ["key", "value"]


def test_a_batch_lost_in_its_write_is_completed(spark, tmp_path, monkeypatch):
    deliver(spark, tmp_path, "a", "b")
    whole = once.append_once

    def half(batch, path, query, number):
        whole(batch.limit(1), path, query, number)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(once, "append_once", half)
        with pytest.raises(Exception, match="lost"):
            drain(spark, tmp_path)
    assert rows(drain(spark, tmp_path), "value") == [("a",), ("b",)]


def test_streams_with_names_of_their_own_share_a_table(spark, tmp_path):
    frame = spark.createDataFrame([("k", "x")], MESSAGES)
    for query in ("one", "two", "one"):
        once.append_once(frame, f"{tmp_path}/t", query, 0)
    once.append_once(frame, f"{tmp_path}/t", "one", 1)
    once.append_once(frame.where("false"), f"{tmp_path}/t", "one", 2)
    assert once.read_appended(spark, f"{tmp_path}/t").count() == 3
    assert once.read_appended(spark, f"{tmp_path}/none", MESSAGES).columns == ["key", "value"]
    assert once.batches(spark, f"{tmp_path}/none").count() == 0


def test_outbox_holds_every_message_once(spark, tmp_path):
    records = feed_records(raw_readings(spark, SF_DIR))
    records.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for _ in range(2):
        once.records_to_outbox(stream(), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        lose_last_commit(f"{tmp_path}/checkpoint")
    sent = once.read_appended(spark, f"{tmp_path}/out")
    assert sent.count() == records.count()
    assert sent.select(F.from_json("value", READING).alias("r")).select("r.*").exceptAll(records).count() == 0
