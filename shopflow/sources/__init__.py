"""shopflow.sources."""
