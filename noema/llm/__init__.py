"""Operators for training-data pipelines: language identification, toxicity,
embedding and n-gram near-duplicate joins, source mixing, chat formatting, token
attribution, decontamination, license scans and suffix-array dedup.

Nothing else in the package imports this subpackage.
"""
