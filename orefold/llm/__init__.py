"""Operators of a training-data pipeline: tokens, packing, classifiers, rules, duplicates, fingerprints, WARC."""
