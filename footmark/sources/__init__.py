"""Sources and sinks: raw layers, fixture layers, counties, output tables."""
