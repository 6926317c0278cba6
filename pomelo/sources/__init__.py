"""Readers: day / latest partition scans, text formats, test fixtures."""
