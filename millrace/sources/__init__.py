"""Where tables and change logs come from."""
