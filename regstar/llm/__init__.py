"""Operators of a training-data pipeline: URL filters, near-duplicate
detection, personal data, quality rules, document fingerprints, language-model
scoring, mixing, toxicity, sharding and packing. Nothing else in the library
imports this subpackage."""
