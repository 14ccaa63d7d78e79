"""Entity definitions and readers."""
