"""End-to-end plans: fixture envelopes, batch ingest, and the query catalogue."""
