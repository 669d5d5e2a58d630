"""DuckDB SQL twins of the Spark queries (test oracle)."""
