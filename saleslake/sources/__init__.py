"""Where rows come from: landing files, seeds and named tables."""
