"""Sources and sinks: the given parquet tables, tab-separated landing files,
JSON API pages, and link listings extracted from HTML pages."""
