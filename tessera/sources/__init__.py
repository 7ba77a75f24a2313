"""Sources and sinks: driver tables, files (CSV, text, LibSVM, XML, JSON) and writers."""
