"""Sources and sinks: raw CSV, Parquet tables, fitted-model folders."""
