"""Stream delivery of the price ingest."""
