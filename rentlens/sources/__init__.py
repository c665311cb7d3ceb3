"""Input schemas, readers, sinks and stage tables."""
