"""loomlake: a PySpark-native lakehouse engine (flatten, upsert, safe views, read-only SQL, profiling)."""
