"""The log job as a stream."""
