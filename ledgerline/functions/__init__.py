"""Column helpers and skew-proof per-key ranking shared by the operators."""
