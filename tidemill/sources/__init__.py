"""Where tables live: chunked Parquet, generated rows, JDBC."""
