"""Sources and sinks: files, landed datasets, keyed generators, images, models."""
