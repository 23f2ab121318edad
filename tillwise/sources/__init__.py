"""Sources: table scans, report grids, generated dimensions."""
