"""Event routing that runs the same on batches and streams."""
