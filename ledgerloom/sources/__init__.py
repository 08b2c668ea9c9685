"""Reading and writing: CSV files, Parquet and catalog tables, JDBC databases."""
