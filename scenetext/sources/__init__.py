"""Where tables come from: files, listings, lines of text, test tables."""
