"""Sources and sinks: listings, grid readers, stand-in fixtures, table writers."""
