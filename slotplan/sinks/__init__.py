"""Writers: CSV / JSON / JS text, chunked export, tables with archive, JDBC."""
