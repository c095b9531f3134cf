"""Sources: tables, payloads and documents as DataFrames."""
