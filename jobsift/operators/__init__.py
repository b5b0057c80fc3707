"""Relational operators of the posting domain: ``f(DataFrame, ...) -> DataFrame``."""
