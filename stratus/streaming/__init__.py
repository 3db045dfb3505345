"""Structured Streaming: message source, parse + watermark, ingest / dedup / enrich sinks."""
