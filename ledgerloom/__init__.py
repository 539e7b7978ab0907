"""Batch ledger analytics for a micro-finance institution, as Spark DataFrame operators."""
