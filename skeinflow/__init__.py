"""Spark-first analytics over article feeds, series and report documents."""
