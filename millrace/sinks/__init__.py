"""Writers that can be repeated without changing the result."""
