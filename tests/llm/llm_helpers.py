def told(df) -> list[tuple]:
    """Rows in an order of their own."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
