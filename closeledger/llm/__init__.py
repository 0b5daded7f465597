"""Operators for large training-data pipelines.

Nothing else in the library imports this package.  ``queries`` holds the
registered queries; every other module is one operator or a helper.
"""
