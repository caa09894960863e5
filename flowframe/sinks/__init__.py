"""Sinks: shape rows for a destination, then hand them to a Spark writer."""
