"""Sources, sinks and their locations."""
