"""Operators for preparing training corpora, one module per operator, and their registered queries."""
