"""Plans: composite pipelines (feature tables, store, lineage) and the
query registry used by ``__spark_entry__``."""
