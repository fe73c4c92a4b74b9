"""Tables in and NDJSON in and out."""
