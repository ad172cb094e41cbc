"""Registered queries: each operator applied to the driver's tables, with independent DuckDB SQL."""
