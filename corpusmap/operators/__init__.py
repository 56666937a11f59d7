"""DataFrame -> DataFrame operators over the four corpus tables."""
