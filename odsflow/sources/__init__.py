"""Readers: tables in files, JDBC, Kafka, incremental loads."""
