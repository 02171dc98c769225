"""aeroline: hourly sensor readings on Spark, from raw messages to a star schema and series."""
