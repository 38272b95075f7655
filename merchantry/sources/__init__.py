"""Where rows come from and where they go: raw files, stored tables, sample data."""
