"""Part of corpusflow."""
