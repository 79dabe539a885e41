"""shopflow.functions."""
