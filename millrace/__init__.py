"""millrace: file cataloguing, tolerant parsing, typed records and search, as PySpark plans."""
