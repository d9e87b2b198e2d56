"""Incremental file streams. Every run takes what is new and stops."""
