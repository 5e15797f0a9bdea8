"""Where rows come from: dump files, dump lines with byte positions, staged datasets."""
