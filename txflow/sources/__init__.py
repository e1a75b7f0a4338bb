"""Readers: files, message streams, stored tables."""
