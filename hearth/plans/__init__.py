"""Models (staging, intermediate, marts), bindings to the test tables, DuckDB
oracle SQL and the registry of checked queries."""
