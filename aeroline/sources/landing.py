"""JSON landing zone: reading, writing, lineage and API bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.functions.times import reading_date, reading_hour
from aeroline.schemas import CORRUPT, READING, READING_WITH_CORRUPT

OLDEST_FILE = "36500d"


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON record per line. Unknown fields are ignored, bad fields become NULL, unreadable lines are kept as text
    in the corrupt-record column."""
    return _with_lineage(_reader(spark).json(path))


def read_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that hold one JSON array. Such a file cannot be split: use it for small deliveries only."""
    return _with_lineage(_reader(spark).option("multiLine", True).json(path))


def stream_json_lines(spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """Landing files as a stream: each file is taken once, new date folders are found by themselves.

    With ``archive``, files are moved there after the batch that read them has been committed.
    """
    reader = spark.readStream.schema(READING_WITH_CORRUPT).option("columnNameOfCorruptRecord", CORRUPT)
    # A file restored from an archive keeps its old date and is still to be read.
    reader = reader.option("recursiveFileLookup", True).option("maxFileAge", OLDEST_FILE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_lineage(reader.json(path))


def _reader(spark: SparkSession):
    reader = spark.read.schema(READING_WITH_CORRUPT).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)


def _with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumn("original_file", F.col("_metadata.file_path"))


def _is_record() -> Column:
    """Whether a line is a JSON object. Spark also keeps the text of objects with a field it cannot parse; such a field
    is NULL, and the rules for readings decide about the rest."""
    return F.col(CORRUPT).isNull() | F.json_object_keys(CORRUPT).isNotNull()


def readable(df: DataFrame) -> DataFrame:
    """Records, those with bad fields included."""
    return df.filter(_is_record()).drop(CORRUPT)


def unreadable(df: DataFrame) -> DataFrame:
    """Quarantine of lines that are no JSON object."""
    return df.filter(~_is_record()).select(F.col(CORRUPT).alias("line"), "original_file")


def with_partitions(df: DataFrame, utc: str = "UTC") -> DataFrame:
    """``date`` and ``hour`` from the reading itself, so they never depend on how folders were named."""
    return df.withColumns({"date": reading_date(utc), "hour": reading_hour(utc)})


def path_partitions(df: DataFrame, path: str = "original_file") -> DataFrame:
    """``path_date`` and ``path_hour`` as named by the folders of a file; NULL where a folder is missing or malformed."""
    date = F.regexp_extract(path, r"date=(\d{4}-\d{2}-\d{2})", 1)
    hour = F.regexp_extract(path, r"hour=(\d{2})", 1)
    return df.withColumns({"path_date": date.try_cast("date"), "path_hour": hour.try_cast("int")})


def landing_rows(records: DataFrame) -> DataFrame:
    """Feed records with the landing partition: the date part of the text time."""
    return records.withColumn("date", F.split("UTC", "T")[0])


def write_landing(records: DataFrame, path: str) -> None:
    """JSON lines under ``date=…/``. Executors write; part-file names are unique, so appends never collide."""
    balanced = landing_rows(records).hint("rebalance", F.col("date"))
    balanced.write.mode("append").option("ignoreNullFields", False).partitionBy("date").json(path)


def landing_counts(records: DataFrame) -> DataFrame:
    """Records per landing partition; summed up, the total written."""
    return landing_rows(records).groupBy("date").agg(F.count(F.lit(1)).alias("records"))


def classify_body(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Add the ``status`` of an API body.

    ``rows``: a list of readings. ``service_error``: an error object, zero rows. ``bad_json``: not JSON, zero rows.
    ``unexpected_object`` / ``unexpected_type``: JSON, but neither of these, which callers should treat as a failure.
    """
    text = F.col(body)
    status = (
        F.when(F.json_array_length(text).isNotNull(), "rows")
        .when(F.get_json_object(text, "$.WebServiceError").isNotNull(), "service_error")
        .when(F.json_object_keys(text).isNotNull(), "unexpected_object")
        .when(F.try_parse_json(text).isNotNull(), "unexpected_type")
        .otherwise("bad_json")
    )
    message = F.get_json_object(text, "$.WebServiceError[0].Message")
    return bodies.withColumns({"status": status, "error_message": message})


def body_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per reading of the bodies that hold readings. Elements are parsed one by one: an odd one costs no other."""
    others = [name for name in bodies.columns if name != body]
    rows = _elements(bodies, body).filter(F.json_object_keys("_element").isNotNull())
    return rows.select(*others, F.from_json("_element", READING).alias("_row")).select(*others, "_row.*")


def _elements(bodies: DataFrame, body: str) -> DataFrame:
    listed = classify_body(bodies, body).filter("status = 'rows'")
    return listed.withColumn("_element", F.explode(F.from_json(body, "array<string>")))


def failed_bodies(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Everything that gave no rows, with its status, for the quarantine table: whole bodies, and of lists the elements
    that are no objects (``bad_element``)."""
    whole = classify_body(bodies, body).filter("status <> 'rows'")
    odd = _elements(bodies, body).filter(F.json_object_keys("_element").isNull())
    odd = odd.withColumns({body: F.coalesce("_element", F.lit("null")), "status": F.lit("bad_element")})
    return whole.unionByName(odd.select(*whole.columns))
