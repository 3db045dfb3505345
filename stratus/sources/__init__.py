"""Sources: test-data adapter, lake tables, message/payload encodings."""
