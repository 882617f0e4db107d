"""Whole runs: the end-to-end plan, the file-to-file jobs, and the registered queries."""
