"""Operators of a training-data pipeline: deduplication, decontamination,
language and quality models, toxicity, secret scans and tokenisation.

Nothing else in the library imports this package.  Every operator takes a
DataFrame and column names and returns a DataFrame; the ``opN_*`` queries in
:mod:`talentflow.llm.queries` only add the digest columns.
"""
