"""DataFrame to DataFrame operators on a document table."""
