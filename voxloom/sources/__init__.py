"""Readers: file discovery, source scans, delimited metadata, profiles."""
