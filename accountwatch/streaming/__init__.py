"""The three detectors as running queries."""
