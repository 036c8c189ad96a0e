"""Operators that prepare text corpora for training: filtering, deduplication, scoring, decontamination and packing."""
