"""Sources and sinks: delimited observation files, the model folder, the
prediction file."""
