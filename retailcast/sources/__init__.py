from retailcast.sources.tables import read_table, retail_daily  # noqa: F401
