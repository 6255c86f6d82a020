"""Operators for preparing training data at corpus scale.

Each module holds one operator; ``registry`` maps query names to thin queries
that apply an operator to a whole table with production parameters.
"""
