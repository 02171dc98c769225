"""Compare every query with its SQL: ``python -m tests.oracle_check SF_DIR [NAME …]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, name, function, sql, sf_dir):
    """(problem or None, seconds, rows). Columns are compared by name, rows without regard to order."""
    started = time.time()
    df = function(spark, sf_dir)
    found = df.toArrow()
    seconds = time.time() - started
    wanted = connection.sql(sql).to_arrow_table()
    names = sorted(found.column_names)
    if names != sorted(wanted.column_names):
        return f"columns {names} != {sorted(wanted.column_names)}", seconds, found.num_rows
    kinds = [(n, str(found.schema.field(n).type), str(wanted.schema.field(n).type)) for n in names]
    kinds = [kind for kind in kinds if kind[1].replace("large_", "") != kind[2].replace("large_", "")]
    if kinds:
        return f"types {kinds}", seconds, found.num_rows
    left = sorted((tuple(row[n] for n in names) for row in found.to_pylist()), key=repr)
    right = sorted((tuple(row[n] for n in names) for row in wanted.to_pylist()), key=repr)
    if left != right:
        only_left, only_right = set(left) - set(right), set(right) - set(left)
        return f"{len(left)} / {len(right)} rows; {list(only_left)[:2]} / {list(only_right)[:2]}", seconds, len(left)
    return None, seconds, len(left)


def main(sf_dir, *names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, statements = contract.queries(), contract.oracle_sql()
    connection = connect(sf_dir)
    failures = 0
    for name in names or queries:
        try:
            problem, seconds, rows = compare(spark, connection, name, queries[name], statements[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, seconds, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0, -1
        failures += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32} {rows:8} rows {seconds:7.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures; without query: {set(statements) - set(queries)}; without SQL: {set(queries) - set(statements)}")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
