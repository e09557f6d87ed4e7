from capstan.sources.tables import Sources

__all__ = ["Sources"]
