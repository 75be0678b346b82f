"""Landing files as a stream: the same ingest, without a date argument."""
