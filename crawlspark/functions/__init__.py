"""Column functions and DataFrame transforms over URLs and attribute values."""
