"""Operators of a training-data pipeline: mixing, packing, search, scans, language, near copies, pages, quality, chat."""
