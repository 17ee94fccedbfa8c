"""Column expressions shared by sources, merges and marts."""
