"""logweave.plans."""
