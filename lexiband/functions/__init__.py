"""Column expressions: tokenising rules and band thresholds."""
