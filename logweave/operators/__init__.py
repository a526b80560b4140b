"""logweave.operators."""
