"""Sources: the named-table catalog and the raw report files."""
