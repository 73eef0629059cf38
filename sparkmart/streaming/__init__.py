"""sparkmart.streaming."""
