"""What a run has done: rows per stage, late readings, odd types. Counted while the rows pass, never by a second scan."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from aeroline.functions.times import reading_time
from aeroline.operators.observed import Counted
from aeroline.schemas import CORRUPT, READING

SCHEMA = "run_id STRING, stage STRING, metric STRING, value STRING"
#: Types that a value of JSON may have where the schema of readings has another name for them.
SAME_TYPE = {"string": ("STRING",), "double": ("DOUBLE", "DECIMAL", "BIGINT", "FLOAT"), "int": ("BIGINT",)}
_PATIENCE = 120


class RunReport:
    """Collects (stage, metric, value) of one run."""

    def __init__(self, spark: SparkSession, run_id: str = ""):
        self._spark, self._run_id = spark, run_id
        self._known: list[tuple[str, str, object]] = []
        self._pending: list[tuple[str, Counted]] = []

    def rows_of(self, stage: str) -> Counted:
        """To be hung on the frame that a stage writes. Ask for it only where the write is sure to happen."""
        self._pending.append((stage, Counted()))
        return self._pending[-1][1]

    def add(self, stage: str, metric: str, value: object) -> None:
        self._known.append((stage, metric, value))

    def values(self) -> dict[tuple[str, str], object]:
        counted = [(stage, "rows", counted.observation.get["rows"]) for stage, counted in self._pending]
        return {(stage, metric): value for stage, metric, value in [*self._known, *counted]}

    def frame(self) -> DataFrame:
        rows = [(self._run_id, stage, metric, str(value)) for (stage, metric), value in self.values().items()]
        return self._spark.createDataFrame(rows, SCHEMA)

    def write(self, path: str) -> None:
        """Appended to the reports of earlier runs: a few rows."""
        self.frame().coalesce(1).write.mode("append").json(path)


class _StreamMetrics(StreamingQueryListener):
    """Observed metrics of all batches, by run: progress itself keeps the last hundred batches only."""

    def __init__(self) -> None:
        self.found: dict[str, list[tuple[str, dict]]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        metrics = event.progress.observedMetrics
        with self._changed:
            self.found.setdefault(str(event.progress.runId), []).extend((name, row.asDict()) for name, row in metrics.items())

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, run: str) -> list[tuple[str, dict]]:
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, _PATIENCE):
                raise TimeoutError("the end of the stream has not been reported")
            return self.found.get(run, [])


def drain(spark: SparkSession, start: Callable[[], StreamingQuery]) -> list[tuple[str, dict]]:
    """Run a bounded stream to its end; (name, metrics) of each of its batches that has observed any."""
    listener = _StreamMetrics()
    spark.streams.addListener(listener)
    try:
        query = start()
        query.awaitTermination()
        return listener.wait_for(str(query.runId))
    finally:
        spark.streams.removeListener(listener)


def landed_metrics(late_before: str | None) -> dict[str, Column]:
    """Counts over landing lines: all, broken ones, those with a field of another type and which types these have, and late ones.

    ``late_before``: readings before it are behind the watermark and will not be taken by an incremental run.
    """
    is_object = F.json_object_keys(CORRUPT).isNotNull()
    late = F.lit(0).cast("long") if late_before is None else F.count_if(reading_time("UTC") < F.lit(late_before).cast("timestamp_ntz"))
    return {
        "rows": F.count(F.lit(1)),
        "broken": F.count_if(F.col(CORRUPT).isNotNull() & ~F.coalesce(is_object, F.lit(False))),
        "odd_types": F.count_if(is_object),
        "late": late,
        # Only odd lines are parsed again; the text of the others is not kept.
        "types": F.schema_of_variant_agg(F.try_parse_json(F.when(is_object, F.col(CORRUPT)))),
    }


def top_fields(text: str) -> dict[str, str]:
    """Fields of a type like ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``; none of another type."""
    inner = re.fullmatch(r"OBJECT<(.*)>", text or "", re.DOTALL)
    fields, depth, start = [], 0, 0
    body = inner.group(1) if inner else ""
    for at, sign in enumerate(body + ","):
        depth += (sign in "<(") - (sign in ">)")
        if sign == "," and depth == 0:
            fields.append(body[start:at])
            start = at + 1
    return {name.strip().strip("`"): kind.strip() for name, _, kind in (f.rpartition(": ") if "<" not in f else f.partition(": ") for f in fields) if name}


def type_differences(found: str, expected: T.StructType = READING) -> list[tuple[str, str, str]]:
    """(column, expected type, found type) for fields whose values another type than the schema's was found for.

    A field with values of several types is VARIANT, one with nulls only is VOID and no difference.
    """
    wanted = {field.name: field.dataType.simpleString() for field in expected.fields}
    return [
        (name, wanted[name], kind) for name, kind in top_fields(found).items()
        if name in wanted and kind != "VOID" and not kind.startswith(SAME_TYPE[wanted[name]])]


def add_landed(report: RunReport, batches: list[tuple[str, dict]]) -> None:
    """Sum the metrics of :func:`landed_metrics` over all batches of a drain."""
    metrics = [values for _, values in batches]
    for name in ("rows", "broken", "odd_types", "late"):
        report.add("bronze", name, sum(values[name] or 0 for values in metrics))
    differences = {d for values in metrics for d in type_differences(values["types"])}
    for column, expected, kind in sorted(differences):
        report.add("bronze", f"type of {column}", f"{kind} instead of {expected}")
