"""shopflow.streaming."""
