"""Sinks. Rows of one label may fill many files; no label is gathered into one task."""
