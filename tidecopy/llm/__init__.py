"""Operators for large training-data pipelines (documents, tokens, chats).

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
