"""DataFrame in, DataFrame out. Nothing in here starts a job."""
