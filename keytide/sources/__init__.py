"""Where rows come from and go to: the commit log and commit directories."""
