"""Sources: file scans, landed-payload readers and the seed dimension."""
