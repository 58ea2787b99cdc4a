"""dossier: per-entity features, splits, scoring and evaluation as Spark jobs.

Rows of dated statements per entity go in; one wide feature row per entity,
exact stratified splits, scores and a weighted ranking metric come out. Every
operator takes and returns DataFrames and works the same on a laptop session
and on a large cluster.
"""

from dossier.spec import EntitySpec

__all__ = ["EntitySpec"]
