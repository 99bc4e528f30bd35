"""Readers: multi-file scans, drifting schemas, month ranges, samples, temporary views."""
