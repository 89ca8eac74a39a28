"""Sources and sinks: typed Parquet storage and the star-schema event views."""
