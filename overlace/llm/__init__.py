"""Training-data operators: decontamination, deduplication, scoring, filtering, packing.

Nothing else in the library imports this subpackage.
"""
