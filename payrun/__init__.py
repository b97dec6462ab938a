"""Payment-batch preparation on Spark: many invoice sheets, one plan."""

from .rules import DEFAULT_RULES, PayRules

__all__ = ["DEFAULT_RULES", "PayRules"]
