"""Reading and writing bars: payloads, CSV files, tables."""
