"""gradus: yearly-table analytics (typing, star schema, features, audits, retrieval) as plain Spark DataFrame functions."""
