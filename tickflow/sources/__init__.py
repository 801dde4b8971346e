"""Sources and sinks: topics, files, the document store and the given tables."""
