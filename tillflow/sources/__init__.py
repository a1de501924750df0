"""Sources: feed files -> raw DataFrames (all text columns) with file order."""
