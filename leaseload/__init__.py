"""Spark-native loading of facility-rental exports into a typed relational model."""

from leaseload.params import Params

__all__ = ["Params"]
