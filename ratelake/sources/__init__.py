"""Readers and writers: landing files, versioned tables, seeds."""
