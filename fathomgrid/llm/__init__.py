"""Operators for preparing training text: scans, rules, classifiers, dedup, mixing, packing, sharding."""
