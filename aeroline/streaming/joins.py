"""Joins of two event streams, by windows or event by event.

By windows: both streams are first reduced to one row per key and time window, so a busy key meets its partner as a
handful of rows instead of as all pairs of its events, and state is bounded by keys × open windows.

Event by event: an event meets those of its key within an interval after it. Both sides carry a watermark, so state holds
the events of one interval and the delay. Pairs are written at once, events without a partner when the watermark shows
that none can come any more.

Either way what is written is final (append mode), and a drained stream ends with windows and events the watermark has not
closed. Nothing of them is lost: :func:`open_windows` and :func:`open_events` give them as a batch over the same input, and
:func:`with_rest` puts both together with a label.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aeroline.functions.times import interval

CLOSED, OPEN = "closed", "open"


def with_state_partitions(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own for a stateful query: the number of state partitions is fixed by its first batch, so it
    should follow the cluster and the expected state, not whatever batch queries in the same session use."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def windowed_counts(events: DataFrame, key: str, moment: str, window: str, delay: str, name: str) -> DataFrame:
    """Events per key and tumbling window, of a stream or of a table; watermarks need a timestamp with a zone, here the
    session's."""
    watched = events.withColumn(moment, F.col(moment).cast("timestamp"))
    if events.isStreaming:
        watched = watched.withWatermark(moment, delay)
    return watched.groupBy(F.window(moment, window), key).agg(F.count(F.lit(1)).alias(name))


def join_windows(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Windowed rows of two streams with the same key and window; ``how`` is inner or left."""
    return left.join(right, ["window", key], how)


def flat_windows(joined: DataFrame) -> DataFrame:
    return joined.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")


def write_closed(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def write_closed_windows(joined: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return write_closed(flat_windows(joined), path, checkpoint)


def final_watermark(query: StreamingQuery) -> datetime | None:
    """The watermark with which a drained query has closed windows and events last; None if it has seen no event."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if p["eventTime"] and "watermark" in p["eventTime"]]
    return datetime.fromisoformat(marks[-1].replace("Z", "+00:00")) if marks else None


def not_before(moment: str, watermark: datetime | None, reach: timedelta) -> Column:
    """Whether what begins at ``moment`` and lasts for ``reach`` may still be open; true for an unknown moment."""
    at = F.col(moment).cast("timestamp")
    if watermark is None:
        return F.lit(True)
    # Eviction works on whole milliseconds; a second more only makes the batch a little larger.
    return F.coalesce(at >= F.lit(watermark - reach - timedelta(seconds=1)), F.lit(True))


def open_windows(
    left: DataFrame, right: DataFrame, key: str, moment: str, window: timedelta, names: tuple[str, str], written: DataFrame,
    watermark: datetime | None, how: str = "inner",
) -> DataFrame:
    """What the rest of a drained windowed join would give if the streams ended here.

    ``left`` and ``right`` are the same input as tables. Only events from the watermark on (less one window) are read; what
    the stream has ``written`` is left out by window and key, so the border between closed and open is the stream's own.
    """
    length = f"{int(window.total_seconds())} seconds"
    sides = [windowed_counts(events.where(not_before(moment, watermark, window)), key, moment, length, "0 seconds", name)
             for events, name in zip((left, right), names)]
    # The first window may have lost events to the cut, but then the watermark has passed its end and it is closed.
    rest = flat_windows(join_windows(*sides, key, how))
    if watermark is not None:
        rest = rest.where(F.col("window_end") > F.lit(watermark - timedelta(seconds=1)))
    return rest.join(written.select("window_start", key), ["window_start", key], "left_anti").select(written.columns)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_moment: str, right_moment: str, within: timedelta, delay: str, how: str = "inner"
) -> DataFrame:
    """Each event of ``left`` with the events of ``right`` of the same key at its time or up to ``within`` after it.

    ``how`` is inner or left. Works on streams and on tables alike; apart from ``key`` the sides have no column in common.
    Time is cut into cells as long as the interval: an event of ``left`` lies in one, an event of ``right`` counts for its own and
    the cell before, and equality on key and cell deals a busy key over many tasks. Each pair still meets once. Events
    without a key or time have no partner; a stream leaves them to :func:`open_events`.
    """
    micros = int(within.total_seconds() * 1_000_000)
    cell = lambda name: F.floor(F.unix_micros(name) / F.lit(micros))
    sides = []
    for side, moment in ((left, left_moment), (right, right_moment)):
        side = side.withColumn(moment, F.col(moment).cast("timestamp"))
        if side.isStreaming:
            side = side.where(F.col(moment).isNotNull() & F.col(key).isNotNull()).withWatermark(moment, delay)
        sides.append(side)
    first = sides[0].withColumn("_cell", cell(left_moment))
    both = F.array(cell(right_moment), cell(right_moment) - 1)
    second = sides[1].withColumnRenamed(key, "_key").withColumn("_of", F.explode(both))
    near = F.col(right_moment).between(F.col(left_moment), F.col(left_moment) + interval(f"{int(within.total_seconds())} seconds"))
    joined = first.join(second, (F.col(key) == F.col("_key")) & (F.col("_cell") == F.col("_of")) & near, how)
    return joined.drop("_cell", "_of", "_key")


def open_events(
    left: DataFrame, right: DataFrame, key: str, left_id: str, left_moment: str, right_moment: str, within: timedelta,
    written: DataFrame, watermark: datetime | None,
) -> DataFrame:
    """Events of ``left`` without a partner that a drained left join has not released: rows as the stream would write them.

    Pairs have all been written, for a pair is joined when its later event comes. ``left`` and ``right`` are the same input
    as tables, read from the watermark on, less the interval; events without a key or time are among them. What the
    stream has ``written`` is left out by ``left_id``.
    """
    late = left.where(not_before(left_moment, watermark, within) | F.col(key).isNull())
    partners = right.where(not_before(right_moment, watermark, within))
    joined = interval_join(late, partners, key, left_moment, right_moment, within, "0 seconds", "left")
    alone = joined.where(F.col(right_moment).isNull()).join(written.select(left_id).distinct(), left_id, "left_anti")
    return alone.select(written.columns)


def with_rest(closed: DataFrame, rest: DataFrame) -> DataFrame:
    """Both, with a column ``state``: closed rows are final, an open one may change if the streams go on."""
    return closed.withColumn("state", F.lit(CLOSED)).unionByName(rest.withColumn("state", F.lit(OPEN)))
