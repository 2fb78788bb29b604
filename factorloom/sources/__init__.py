"""Readers and writers: bars, dimensions, choice lists, day files, metric store."""
