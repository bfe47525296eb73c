"""Writers for tables, files and connectors."""
