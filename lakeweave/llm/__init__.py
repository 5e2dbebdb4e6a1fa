"""Training-data operators: quality, duplicates, decontamination, tokens, search, privacy, links, mixing."""
