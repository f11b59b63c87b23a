"""Sources and sinks: driver tables, retail views, landing files, tables."""
