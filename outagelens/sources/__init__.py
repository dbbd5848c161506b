"""Readers, partitioned tables, the ingestion ledger and the stand-in views."""
