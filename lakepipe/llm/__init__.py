"""Training-data operators: scoring, search, deduplication, redaction and mixing of text corpora.

Each operator is one module with a general interface (DataFrame in, DataFrame
out); ``queries`` holds the registered ``opN_*`` queries.  Nothing else in the
library imports this subpackage.
"""
