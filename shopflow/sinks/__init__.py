"""shopflow.sinks."""
