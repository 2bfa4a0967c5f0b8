"""Raw feeds and files derived from the test tables."""
