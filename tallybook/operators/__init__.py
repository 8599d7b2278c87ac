"""tallybook.operators."""
