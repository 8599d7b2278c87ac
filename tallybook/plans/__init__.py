"""tallybook.plans."""
