"""Stored tables as streams.

Filters, the pattern rule and the threshold rules are plain DataFrame operators and work on a
stream as they are.
"""
