"""Per-row rules written as Spark column expressions."""
