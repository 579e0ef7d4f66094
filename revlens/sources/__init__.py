"""Sources and sinks: raw review dumps, the parquet store, CSV interchange, exports, the test view."""
