"""The operators run on the TPC-H-like trial tables, with their equivalents in SQL."""
