"""Training-data operators: sharding, near and exact dedup, packing, personal data, fingerprints, secrets,
quality, token files and mixing. Nothing else in the library imports this subpackage."""
