"""Silver, gold and insight tables as lazy plans."""
