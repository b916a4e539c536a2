"""Sources and sinks: fixture stand-ins, incident files, hourly weather JSON, table writers."""
