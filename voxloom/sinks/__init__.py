"""Writers: sharded Parquet, drop logs, manifests, in-place replacement."""
