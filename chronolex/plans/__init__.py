"""The test data adapter, the queries with their SQL, and whole runs."""
