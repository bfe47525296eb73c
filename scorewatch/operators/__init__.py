"""DataFrame to DataFrame functions."""
