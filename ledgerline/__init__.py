"""Analytics and upkeep of a background-job ledger, as Spark DataFrame operators."""
