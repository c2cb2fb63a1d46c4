"""Registered queries: ``catalog()`` gathers the ones of every module that defines some."""
