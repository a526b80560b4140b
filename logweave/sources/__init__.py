"""logweave.sources."""
