"""What tests share."""


def bag(df):
    """The rows of a frame in an order of their own, for comparison as a multiset."""
    columns = sorted(df.columns)
    return sorted(
        (tuple(row[c] for c in columns) for row in df.collect()),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )
