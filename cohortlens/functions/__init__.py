from .columns import numeric

__all__ = ["numeric"]
