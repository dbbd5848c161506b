"""Incremental ingestion as a file stream, beside the ledger-driven batch."""
