"""Tagged key-value-store exports to clean, partitioned tables, on Spark."""
