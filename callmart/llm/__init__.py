"""Operations of a training-data pipeline: dedup, privacy, quality, toxicity, tokens, packing, placement, search."""
