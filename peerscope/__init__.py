"""peerscope: peer-based price analytics as plain PySpark DataFrame operators.

Every operator takes DataFrames (plus parameters) and returns a lazy DataFrame;
nothing is collected to the driver.  Column roles (which column is the entity,
the snapshot date, the city, ...) are given by :class:`peerscope.roles.Roles`
so the same code runs on the rental schema and on any bound test schema.
"""

from peerscope.roles import Roles, SimilarityWeights  # noqa: F401

__all__ = ["Roles", "SimilarityWeights"]
