"""Operators of a training-data pipeline over large document tables.

Nothing else in the library imports this package. ``queries`` lists the
registered query of each operator, ``checks`` the SQL of those that SQL states.
"""

from tellurion.llm.queries import checks, queries

__all__ = ["checks", "queries"]
