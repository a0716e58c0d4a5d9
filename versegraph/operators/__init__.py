"""Generic DataFrame -> DataFrame operators; tables and columns are parameters."""
