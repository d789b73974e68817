"""Media lakehouse jobs for Spark: landing, staging and the answers on top."""
