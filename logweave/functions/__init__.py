"""logweave.functions."""
