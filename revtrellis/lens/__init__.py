"""Revenue-operations entities over the generic test tables."""
