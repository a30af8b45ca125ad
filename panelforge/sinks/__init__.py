"""Writers: laid-out Parquet, append-once loads, audit events, CSV exports."""
