"""DataFrame operators of both jobs."""
