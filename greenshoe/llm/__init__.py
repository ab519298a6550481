"""Operations of a training-data pipeline: scans, filters, near duplicates, mixing, token files."""
