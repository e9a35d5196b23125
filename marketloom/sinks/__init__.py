"""Outputs: partition-replacing layer tables, snapshots, published serving tables, reports."""
