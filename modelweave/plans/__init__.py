"""Plan shapes shared by the operators: stored frames, dense positions, paged groups."""
