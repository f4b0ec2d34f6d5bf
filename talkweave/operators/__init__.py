"""DataFrame to DataFrame operators of the two jobs."""
