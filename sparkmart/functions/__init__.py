"""sparkmart.functions."""
