"""Whole batches and the sample queries, as calls of the operators in dependency order."""
