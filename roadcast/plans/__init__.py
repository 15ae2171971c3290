"""The four jobs, composed from sources, operators and sinks."""
