"""Structured Streaming form of the in-season ingest (see ``inseason``)."""
