"""Column functions: time, tags and state algebra."""
