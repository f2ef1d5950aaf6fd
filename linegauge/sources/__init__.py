"""Scans of landed JSON, table sinks, schemas, fixed values and test-table adapters."""
