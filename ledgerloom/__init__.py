"""Ledger, graph and profiling analytics for transaction data on Spark."""
