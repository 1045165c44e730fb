"""Where rows come from: files, tables and the sample data."""
