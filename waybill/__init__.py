"""A Spark-first engine for invoice extraction, master-data validation and entity resolution."""
