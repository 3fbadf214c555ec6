"""Layered retail warehouse on Spark: raw tables, conformed tables, star schema, incremental loads."""
