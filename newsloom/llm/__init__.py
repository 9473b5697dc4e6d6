"""Training-data operators: near and exact dedup, repeated spans, decontamination, language
ID, HTML extraction, WARC, source mixing and secret scans.

Every module holds one operator with its own general interface; ``queries`` registers them.
Nothing outside this package (but ``__spark_entry__`` and ``corpus_pipeline``) imports it.
"""
