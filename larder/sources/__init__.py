"""Table declarations, scans, verified loads and run artifacts."""
