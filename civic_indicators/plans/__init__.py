"""The three report flows and their reports, composed from the operators."""

from civic_indicators.plans import guidance, placement, registration  # noqa: F401

__all__ = ["guidance", "placement", "registration"]
