"""Writers: file tables and JDBC tables."""
