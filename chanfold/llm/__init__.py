"""Operators of a training-data pipeline: token files, neighbour search,
deduplication, packing, classifiers, byte-level BPE and chat formatting.

Nothing outside this subpackage imports it.
"""
