"""The registered queries over the TPC-H-like tables, and their SQL for comparison."""
