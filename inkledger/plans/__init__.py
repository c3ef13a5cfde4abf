"""Reports over the stored tables."""
