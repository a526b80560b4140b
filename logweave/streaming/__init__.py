"""logweave.streaming."""
