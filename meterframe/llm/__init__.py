"""Operators of a training-data pipeline: deduplication, decontamination,
quality and language classification, tokenisation, chat formatting, language
modelling and nearest-neighbour search.

Nothing else in the library imports this subpackage.
"""
