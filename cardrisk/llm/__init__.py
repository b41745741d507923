"""Operators for preparing large training corpora.

One module per operator; ``queries`` registers them over the corpus tables
(documents, pages, conversations, embeddings, labels). Nothing else in the
library imports this subpackage.
"""
