"""tallybook.functions."""
