"""Readers and writers: recordings, frame datasets, reports, synthetic signals."""
