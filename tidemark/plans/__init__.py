"""Composites: transforms, ingest, staging, marts, replication and the whole run."""
