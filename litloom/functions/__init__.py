"""Column functions: text keys and scores."""
