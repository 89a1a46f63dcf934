"""Vectors of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def sound_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None for those that are null, empty, or hold a null or non-finite component."""
    out = []
    for v in column:
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                x = None
        out.append(x)
    return out


def matrix(raws: list[bytes], kind: str) -> np.ndarray:
    """Equally long packed vectors as rows."""
    return np.frombuffer(b"".join(raws), kind).reshape(len(raws), -1)
