"""Daily totals of streams, handed to batch runs."""
