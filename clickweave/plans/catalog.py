"""Imports every module that registers queries."""

from clickweave.plans import aggregation, behaviour, features, joining, organizing, products, projection, ranking, storage, streams  # noqa: F401
from clickweave.plans.registry import BUILDERS, SQL  # noqa: F401
