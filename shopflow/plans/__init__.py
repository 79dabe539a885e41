"""shopflow.plans."""
