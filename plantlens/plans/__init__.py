"""Silver and gold layers, signal and transcript jobs, and the registry of checkable queries."""
