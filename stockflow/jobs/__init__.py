"""spark-submit entry points."""
