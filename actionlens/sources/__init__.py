"""Input schemas, readers and writers."""
