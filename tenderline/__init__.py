"""Bulk pricing of commercial bids, written as Spark DataFrame jobs."""
