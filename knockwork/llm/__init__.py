"""Operations of a training-data pipeline: quality, tokens, duplicates, language, toxicity, pages, archives."""
