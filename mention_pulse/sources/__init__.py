"""Readers and writers: files, encoded records, run snapshots."""
