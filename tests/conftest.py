import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"

READING_SCHEMA = (
    "event_id BIGINT, utc STRING, parameter STRING, unit STRING, aqi INT, category INT, fullaqscode STRING, "
    "intlaqscode STRING, sitename STRING, agencyname STRING, latitude DOUBLE, longitude DOUBLE"
)
GOOD = {
    "event_id": 1, "utc": "2026-03-04T14:00", "parameter": "OZONE", "unit": "PPB", "aqi": 17, "category": 1,
    "fullaqscode": "112233445", "intlaqscode": "840112233445", "sitename": "Harbour", "agencyname": "City Office",
    "latitude": 35.25, "longitude": -90.5,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(folder / "checkpoint"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Build readings from changes to a good one; event ids count up from 1."""
    def build(*changes):
        rows = [{**GOOD, "event_id": i, **change} for i, change in enumerate(changes, 1)]
        names = [part.split()[0] for part in READING_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(row[name] for name in names) for row in rows], READING_SCHEMA)
    return build


def rows(df, *columns):
    """Rows as sorted tuples, dates and timestamps as text."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(str(v) if hasattr(v, "isoformat") else v for v in row) for row in selected.collect()), key=repr)


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    names = sorted(left.columns)
    assert left.select(*names).exceptAll(right.select(*names)).count() == 0
    assert right.select(*names).exceptAll(left.select(*names)).count() == 0


def ids(df):
    return sorted(row[0] for row in df.select(F.col("event_id")).collect())
