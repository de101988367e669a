"""List consolidation and screening on Spark."""
