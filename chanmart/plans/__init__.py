"""Model plans: staging, marts, and the end-to-end pipeline."""

from chanmart.plans import marts, staging

__all__ = ["marts", "staging"]
