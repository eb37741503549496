"""spendlens: transaction enrichment, monthly features and segments on Spark."""
