"""Reading raw feeds, writing and publishing results."""
