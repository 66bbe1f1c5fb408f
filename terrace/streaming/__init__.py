"""Incremental processing: high-watermark extracts and file-stream ingestion with exactly-once sinks."""
