"""Jobs: cleaning, dimensions, facts, reports and the whole build."""
