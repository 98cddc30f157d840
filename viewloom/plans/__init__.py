"""Complete jobs: each takes input frames and plain arguments and returns its result frame."""
