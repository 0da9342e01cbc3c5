"""Sources and sinks: driver parquet tables, derived fixtures, the
reference's CSV / text inputs, and report sinks."""
