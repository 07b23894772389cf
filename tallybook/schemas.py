"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Column names and types of the three tables and of the telegram table.
TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("transaction_date", T.TimestampType()),
    T.StructField("amount", MONEY),
    T.StructField("account_id", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("reference_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("processing_timestamp", T.TimestampType()),
])

RESULTS = T.StructType([
    T.StructField("reconciliation_id", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("primary_transaction_id", T.StringType()),
    T.StructField("secondary_transaction_id", T.StringType()),
    T.StructField("match_status", T.StringType()),
    T.StructField("discrepancy_type", T.StringType()),
    T.StructField("discrepancy_amount", MONEY),
    T.StructField("reconciliation_timestamp", T.TimestampType()),
    T.StructField("notes", T.StringType()),
])

BATCHES = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("reconciliation_date", T.TimestampType()),
    T.StructField("source_systems", T.ArrayType(T.StringType())),
    T.StructField("start_date", T.TimestampType()),
    T.StructField("end_date", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("matched_count", T.LongType()),
    T.StructField("unmatched_count", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
])

TELEGRAMS = T.StructType([
    T.StructField("Id", T.IntegerType(), False),
    T.StructField("TelegramCode", T.IntegerType()),
    T.StructField("Source", T.IntegerType()),
    T.StructField("Destination", T.IntegerType()),
    T.StructField("DateIn", T.TimestampType()),
    T.StructField("DateOut", T.TimestampType()),
    T.StructField("Body", T.StringType()),
])
