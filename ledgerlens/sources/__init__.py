"""Table schemas, loading, sinks and the derived test tables."""
