"""Order intake: field validation, uniqueness, insert, listing, and a
Structured Streaming job that applies the same steps per micro-batch."""
