from . import bins, days, finance, probability, text

__all__ = ["bins", "days", "finance", "probability", "text"]
