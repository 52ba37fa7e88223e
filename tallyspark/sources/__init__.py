"""Scans, lineage and sinks (raw layer, publish, refresh)."""
