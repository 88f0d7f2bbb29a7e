"""Sources and sinks: captured tables, derived inputs, index tables."""
