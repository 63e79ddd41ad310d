"""The operators run over the given Parquet tables, each beside its SQL."""
