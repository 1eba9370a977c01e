"""Jobs: which operators feed which result tables."""
