"""The row-wise stages on a stream of files."""
