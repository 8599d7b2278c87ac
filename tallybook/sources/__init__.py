"""tallybook.sources."""
