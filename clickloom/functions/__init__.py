"""Column-level helpers: nested paths, calendar keys, day keys."""
