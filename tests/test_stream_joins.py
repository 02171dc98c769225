"""Joins of event streams: every event appears once, final or labelled open."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aeroline.streaming import joins
from tests.conftest import rows

START = datetime(2026, 3, 1)
HOUR = timedelta(hours=1)
LEFT, RIGHT = "user string, view_id long, viewed_at timestamp_ntz", "user string, purchase_id long, purchased_at timestamp_ntz"


def make(seed, count=160):
    """Views and purchases of a busy user and some others, with equal times, times at the edge of the interval, and gaps."""
    chance = random.Random(seed)

    def moment():
        return START + timedelta(minutes=chance.choice([30, 60, 7]) * chance.randrange(60))

    users = ["busy"] * 4 + ["a", "b", "c"]
    views = [(chance.choice(users), i, moment()) for i in range(count)]
    purchases = [(chance.choice(users), 1000 + i, moment()) for i in range(count // 3)]
    return views, purchases


def deliver(spark, folder, data, schema, at, parts):
    """Files in order of time, so that a stream of one file a batch meets no late event."""
    data = sorted(data, key=lambda r: r[at])
    size = max(1, -(-len(data) // parts))
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i:i + size], schema).coalesce(1).write.mode("append").parquet(folder)


def drained(spark, tmp_path, views, purchases, how, parts):
    session = joins.with_state_partitions(spark, 3)
    for name, data, schema in (("views", views, LEFT), ("purchases", purchases, RIGHT)):
        deliver(spark, f"{tmp_path}/{name}", data, schema, 2, parts)
    streams = [session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}") for name, schema in (("views", LEFT), ("purchases", RIGHT))]
    joined = joins.interval_join(*streams, "user", "viewed_at", "purchased_at", HOUR, "100 hours" if parts > 1 else "10 minutes", how)
    query = joins.write_closed(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{tmp_path}/out"), joins.final_watermark(query)


def brute(views, purchases):
    pairs = {(v, p) for u, v, t in views for w, p, s in purchases if u == w and t <= s <= t + HOUR}
    alone = {v for _, v, _ in views} - {v for v, _ in pairs}
    return pairs, alone


@pytest.mark.parametrize("parts", [1, 3])
def test_pairs_and_lone_events_equal_brute_force(spark, tmp_path, parts):
    views, purchases = make(parts)
    closed, watermark = drained(spark, tmp_path, views, purchases, "left", parts)
    pairs, alone = brute(views, purchases)
    tables = [spark.createDataFrame(d, s) for d, s in ((views, LEFT), (purchases, RIGHT))]
    rest = joins.open_events(*tables, "user", "view_id", "viewed_at", "purchased_at", HOUR, closed, watermark)
    found = joins.with_rest(closed, rest).select("view_id", "purchase_id", "state").collect()
    assert sorted((r[0], r[1]) for r in found if r[1]) == sorted(pairs)
    assert sorted(r[0] for r in found if r[1] is None) == sorted(alone)
    assert {r[2] for r in found if r[1]} == {joins.CLOSED}
    if parts == 1:  # the watermark has passed most of the events, not the last hour
        states = [r[2] for r in found if r[1] is None]
        assert states.count(joins.CLOSED) > 5 and states.count(joins.OPEN) > 0


def test_inner_join_writes_every_pair(spark, tmp_path):
    views, purchases = make(9)
    closed, _ = drained(spark, tmp_path, views, purchases, "inner", 1)
    assert sorted((r["view_id"], r["purchase_id"]) for r in closed.collect()) == sorted(brute(views, purchases)[0])


def test_tables_are_joined_by_the_same_function(spark):
    views, purchases = make(4)
    views += [(None, 900, START), ("a", 901, None)]
    purchases += [(None, 1900, START), ("a", 1901, None)]
    tables = [spark.createDataFrame(d, s) for d, s in ((views, LEFT), (purchases, RIGHT))]
    found = joins.interval_join(*tables, "user", "viewed_at", "purchased_at", HOUR, "1 hour", "left").collect()
    pairs, alone = brute([v for v in views if v[0] and v[2]], [p for p in purchases if p[0] and p[2]])
    assert sorted((r["view_id"], r["purchase_id"]) for r in found if r["purchase_id"]) == sorted(pairs)
    assert sorted(r["view_id"] for r in found if r["purchase_id"] is None) == sorted(alone | {900, 901})


def test_events_without_key_or_time_and_empty_streams(spark, tmp_path):
    views = [("a", 1, START), ("a", 2, START + 9 * HOUR), (None, 3, START), ("a", 4, None)]
    session = joins.with_state_partitions(spark, 2)
    spark.createDataFrame(views, LEFT).write.parquet(f"{tmp_path}/views")
    spark.createDataFrame([], RIGHT).write.parquet(f"{tmp_path}/purchases")
    streams = [session.readStream.schema(s).parquet(f"{tmp_path}/{n}") for n, s in (("views", LEFT), ("purchases", RIGHT))]
    joined = joins.interval_join(*streams, "user", "viewed_at", "purchased_at", HOUR, "1 hour", "left")
    query = joins.write_closed(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    closed = spark.read.schema(joined.schema).parquet(f"{tmp_path}/out")
    tables = [spark.read.schema(s).parquet(f"{tmp_path}/{n}") for n, s in (("views", LEFT), ("purchases", RIGHT))]
    rest = joins.open_events(*tables, "user", "view_id", "viewed_at", "purchased_at", HOUR, closed, joins.final_watermark(query))
    assert rows(joins.with_rest(closed, rest), "view_id", "purchase_id") == [(i, None) for i in (1, 2, 3, 4)]


def test_a_restarted_join_goes_on_from_its_state(spark, tmp_path):
    """The partner comes in a later run; the open event of the first run is not released twice."""
    session = joins.with_state_partitions(spark, 2)
    write = lambda name, data, schema: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    def run():
        streams = [session.readStream.schema(s).parquet(f"{tmp_path}/{n}") for n, s in (("views", LEFT), ("purchases", RIGHT))]
        joined = joins.interval_join(*streams, "user", "viewed_at", "purchased_at", HOUR, "1 hour", "left")
        query = joins.write_closed(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination()
        closed = spark.read.schema(joined.schema).parquet(f"{tmp_path}/out")
        tables = [spark.read.schema(s).parquet(f"{tmp_path}/{n}") for n, s in (("views", LEFT), ("purchases", RIGHT))]
        rest = joins.open_events(*tables, "user", "view_id", "viewed_at", "purchased_at", HOUR, closed, joins.final_watermark(query))
        return rows(joins.with_rest(closed, rest), "view_id", "purchase_id", "state")

    write("views", [("a", 1, START), ("a", 2, START + 5 * HOUR)], LEFT)
    write("purchases", [("b", 10, START + 5 * HOUR)], RIGHT)
    assert run() == [(1, None, joins.CLOSED), (2, None, joins.OPEN)]
    write("purchases", [("a", 11, START + 5 * HOUR + timedelta(minutes=30)), ("b", 12, START + 30 * HOUR)], RIGHT)
    write("views", [("b", 3, START + 30 * HOUR)], LEFT)
    assert run() == [(1, None, joins.CLOSED), (2, 11, joins.CLOSED), (3, 12, joins.CLOSED)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_closed_and_open_windows_together_are_all_windows(spark, tmp_path, how):
    chance = random.Random(2)
    events = [(chance.choice("ab"), chance.choice(["view", "purchase"]), START + timedelta(hours=chance.randrange(100))) for _ in range(90)]
    events.append(("c", "view", START + timedelta(hours=100)))
    schema = "user string, kind string, ts timestamp_ntz"
    table = spark.createDataFrame(events, schema)
    table.coalesce(1).write.parquet(f"{tmp_path}/events")
    stream = joins.with_state_partitions(spark, 2).readStream.schema(schema).parquet(f"{tmp_path}/events")
    of, names = [F.col("kind") == k for k in ("view", "purchase")], ("views", "purchases")
    sides = [joins.windowed_counts(stream.where(k), "user", "ts", "1 day", "1 hour", n) for k, n in zip(of, names)]
    query = joins.write_closed_windows(joins.join_windows(*sides, "user", how), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    closed = spark.read.parquet(f"{tmp_path}/out")
    rest = joins.open_windows(*[table.where(k) for k in of], "user", "ts", timedelta(days=1), names, closed, joins.final_watermark(query), how)
    found = rows(joins.with_rest(closed, rest), "user", "window_start", "views", "purchases", "state")
    counts = {}
    for user, kind, ts in events:
        counts.setdefault((user, str(ts.replace(hour=0))), [0, 0])[kind == "purchase"] += 1
    wanted = [(u, day, v, p or None) for (u, day), (v, p) in counts.items() if v and (p or how == "left")]
    assert sorted(f[:4] for f in found) == sorted(wanted, key=repr) or sorted((f[:4] for f in found), key=repr) == sorted(wanted, key=repr)
    assert {f[4] for f in found} == {joins.CLOSED, joins.OPEN}
    assert {f[1] for f in found if f[4] == joins.OPEN} >= {str(START + timedelta(days=4))[:19]} or how == "inner"
