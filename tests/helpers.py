"""What several test modules use."""


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
