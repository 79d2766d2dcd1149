"""Readers of archived pages, records, robots rules and sitemaps; sinks."""
