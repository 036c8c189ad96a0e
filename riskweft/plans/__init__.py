"""Jobs, and the registry of checked queries."""
