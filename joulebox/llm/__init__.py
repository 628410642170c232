"""Training-data operators: quality, search, PII, decontamination, toxicity,
near-duplicates, repeated passages, languages, tokens and URL lists.

``queries`` registers one ``opN_<name>`` query for each and the pipeline.
Nothing outside this folder imports it but ``__spark_entry__`` (when present)
and ``corpus_pipeline``.
"""
