from segscore.sources.tables import read_table, read_csv_table, trim_columns  # noqa: F401
