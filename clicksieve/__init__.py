"""Fraud analytics over large click logs, written as PySpark DataFrame jobs."""
