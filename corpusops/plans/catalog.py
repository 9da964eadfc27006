"""Every registered query with its SQL; None where SQL cannot express it."""

from __future__ import annotations

from corpusops.plans import audits, columns, corpus, dataset, evaluation, retrieval, training

QUERIES = {**corpus.QUERIES, **dataset.QUERIES, **retrieval.QUERIES, **evaluation.QUERIES, **training.QUERIES, **columns.QUERIES, **audits.QUERIES}
