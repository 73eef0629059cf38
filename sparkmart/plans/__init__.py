"""sparkmart.plans."""
