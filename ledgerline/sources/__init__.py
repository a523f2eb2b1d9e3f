"""Ledger schemas, readers and the versioned snapshot store."""
