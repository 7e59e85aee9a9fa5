"""The row-local operators on a stream of documents."""
