"""Key-driven table work on Spark: see README.md."""
