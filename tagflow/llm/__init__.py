"""Training-data operators: licences, URLs, duplicates, scoring, search, tokens and packing."""
