"""Readers and writers: message logs, documents, archive payloads, CSV and tables."""
