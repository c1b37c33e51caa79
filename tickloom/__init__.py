"""Trade-tick analytics on Spark: ingest, merge, audit and information-driven bars."""
