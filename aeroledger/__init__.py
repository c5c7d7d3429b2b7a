"""Airline-operations analytics as composable Spark DataFrame functions.

``functions``  column expressions and the fixed values they use
``operators``  DataFrame -> DataFrame building blocks
``sources``    CSV, parquet and JDBC readers and writers
``plans``      the cleaned (silver), summary (gold) and report tables
"""
