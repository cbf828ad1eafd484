"""Readers and writers: tables, snapshots, CSV loads, JSON-lines history."""
