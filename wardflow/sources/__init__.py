"""Sources and sinks: parquet scans, views onto the test tables, writers."""
