"""Sources and sinks: parquet tables, CSV, pandas frames, files and models."""
