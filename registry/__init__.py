"""The queries of ``__spark_entry__`` and the SQL that must give the same rows."""
