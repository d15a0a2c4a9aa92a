"""Sources: zipped CSV extracts, the CSV dialect, landing listings, bronze."""
