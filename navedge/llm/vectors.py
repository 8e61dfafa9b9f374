"""Integer vectors: scaling, exact inner products and their range."""

from __future__ import annotations

SCALE = 256
#: Scores beyond the range of long count as its ends.
MOST = (1 << 63) - 1
#: Stands for a null identifier, after all others.
NO_ID = MOST


def scaled_rows(column, width: int):
    """(kept positions, matrix of whole numbers as double) of an Arrow list column: floor(SCALE * component).

    Vectors that are null, or hold null, a non-finite component or one whose
    multiple leaves the range of double, are left out; short ones are filled up with zeros.
    """
    import numpy as np

    rows, kept = [], []
    for i, v in enumerate(column.to_pylist()):
        if v is None or any(x is None for x in v):
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(np.array(v, np.float64) * SCALE)
        if np.isfinite(x).all():
            kept.append(i)
            rows.append(np.pad(x, (0, width - len(x))))
    return kept, np.array(rows, np.float64).reshape(len(rows), width)


def whole_scores(q, x):
    """Inner products of whole numbers held as double, as long; by floating point only where that is exact.

    A product beyond the range of long counts as that range's end.
    """
    import numpy as np

    most = float(abs(q).max(initial=0)) * float(abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 1 << 53:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m.tolist()], object).reshape(m.shape)
    out = whole(q) @ whole(x).T
    return np.array([[max(-MOST, min(MOST, int(v))) for v in r] for r in out], np.int64).reshape(len(q), len(x))
