"""Operators of a training-data pipeline: scoring, deduplication, search,
packing, archives, tokens and licence scans over a corpus of documents.

Nothing else in the library imports this subpackage.  Executors import it by
name, so it has to be on their Python path (installed, or sent with
``--py-files``)."""
