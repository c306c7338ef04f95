"""Table and scan-report readers and writers."""
