"""Event-time windows and row hooks over streams."""
