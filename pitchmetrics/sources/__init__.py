"""Sources: stream records, dimension files, stored tables, requests, test-data adapter."""
