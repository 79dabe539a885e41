"""shopflow.operators."""
