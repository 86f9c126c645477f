"""Corpus operators for training-data pipelines: decontamination, toxicity, deduplication,
extraction, archives, packing, fingerprints and redaction.  Nothing else in the library imports
this subpackage."""
