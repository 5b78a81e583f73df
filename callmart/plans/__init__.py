"""The six pipelines, composed from the operators."""
