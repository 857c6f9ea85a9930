"""Sources and sinks: Parquet tables, reference-relation bindings, CSV, JSON."""
