"""Readers and writers: snapshots, legacy documents, CSV folders, messages, databases."""
