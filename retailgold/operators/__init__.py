from retailgold.operators import arrivals, gold, quality, selection, typed

__all__ = ["arrivals", "gold", "quality", "selection", "typed"]
