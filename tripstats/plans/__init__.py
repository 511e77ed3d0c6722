"""Reports and pipelines, composed from the operators."""
