"""Published lists and result files."""
