"""Writers: files, catalogue tables, relational databases, layered lake."""
