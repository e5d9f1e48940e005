"""Sources, sinks and the raw-table stand-ins."""
