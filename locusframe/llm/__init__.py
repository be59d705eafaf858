"""Training-data operators over documents and conversations.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator. Nothing else in the library imports this
subpackage.
"""
