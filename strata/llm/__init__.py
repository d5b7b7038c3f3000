"""Operations of a training-data pipeline: deduplication, extraction,
decontamination, mixing, tokenisation and language identification."""
