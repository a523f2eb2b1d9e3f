"""The supplied tables seen as a job ledger, and every operator as a named query over them."""
