"""Readers and writers: archives, articles, catalogue listings, language table."""
