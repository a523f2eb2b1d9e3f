"""The ledger's periodic jobs as Structured Streaming queries."""
