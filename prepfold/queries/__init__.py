"""Checked queries over the driver tables, one module per SURVEY section.

Importing this package fills ``catalog.REGISTRY``.
"""

from . import cleaning, encoding, features, joins, modelling, profiling, scaling, splitting  # noqa: F401
