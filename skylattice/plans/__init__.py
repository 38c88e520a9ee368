"""Every operator applied to the given tables, with the same result as SQL."""

from .catalog import Tables, oracle, registry

__all__ = ["Tables", "oracle", "registry"]
