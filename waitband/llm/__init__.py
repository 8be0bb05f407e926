"""Training-data operators: sharding, BPE, quality rules, toxicity,
near-duplicates, decontamination, secret scans, packing, WARC, substring dedup,
embedding whitening, SimHash, periodic runs.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its
queries only if it is there).
"""
