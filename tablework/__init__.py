"""Table and stream operators written against the PySpark DataFrame API."""
