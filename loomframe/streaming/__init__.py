"""The change jobs as micro-batches."""
