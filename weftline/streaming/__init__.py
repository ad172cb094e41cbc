"""Incremental demand: monthly sums of a stream of order lines."""
