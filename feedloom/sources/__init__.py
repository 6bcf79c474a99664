"""Sources and sinks: test-table fixtures, raw stream ingest, timeline stores."""
