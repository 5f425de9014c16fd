"""Operations on training text: language, duplicates, quality, contamination, archives, toxicity, tokens."""
