"""tidemark: incremental warehouse loading and data-quality checks on Spark."""
