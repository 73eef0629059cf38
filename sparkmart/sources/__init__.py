"""sparkmart.sources."""
