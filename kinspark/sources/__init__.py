"""Sources of the record-linkage engine."""
