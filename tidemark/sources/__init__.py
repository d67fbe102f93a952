"""Readers: landed JSON payloads, tables by logical name, incremental reads."""
