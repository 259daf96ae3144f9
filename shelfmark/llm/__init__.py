"""Training-data operators: language id, toxicity, sharding, dedup, packing,
decontamination, scoring, quality rules and licence scans.  Nothing outside
this folder (and ``corpus_pipeline.py``) imports it."""
