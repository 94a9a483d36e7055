"""Change streams and streaming sinks."""
