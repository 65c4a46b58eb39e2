"""Where results go: partitioned tables and image files."""
