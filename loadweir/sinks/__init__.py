"""Sinks: thin wrappers that write the frames the operators return."""
