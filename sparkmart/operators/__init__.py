"""sparkmart.operators."""
