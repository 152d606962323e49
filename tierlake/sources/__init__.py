"""Sources: message logs, layer tables, relational tables."""
