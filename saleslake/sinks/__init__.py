"""Where rows go: landing folders, bronze partitions, replaced tables, a warehouse."""
