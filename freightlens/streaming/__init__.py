"""The incremental load as a stream."""
