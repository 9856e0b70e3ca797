"""Comparing frames of two engines."""


def rows_of(frame):
    """Rows of a pandas frame with columns by name, order-insensitive."""
    columns = sorted(frame.columns)
    values = frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()
    return columns, sorted([tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in values])
