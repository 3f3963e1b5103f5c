"""textquarry: corpus annotation, deduplication and sampling expressed as Spark plans."""
