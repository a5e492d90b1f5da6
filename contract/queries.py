"""All checked queries. Importing the modules fills the registry."""

from contract import audit, money_plans, parts, reject_plans, scalar_functions, stored, tenancy_plans  # noqa: F401
from contract.registry import CHECKS

__all__ = ["CHECKS"]
