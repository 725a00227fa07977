"""Number arrays as compressed bytes, for rows that stand for a whole block of documents."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(values: np.ndarray) -> bytes:
    """Non-negative numbers, compressed plane by plane of their bytes: small ones cost little."""
    planes = np.ascontiguousarray(np.asarray(values).astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return squeezed(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueezed(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def squeezed_text(data: bytes) -> bytes:
    """Texts end to end; copies far apart in a block are found too."""
    parameters = zstandard.ZstdCompressionParameters.from_level(6, window_log=24, enable_ldm=True)
    return zstandard.ZstdCompressor(compression_params=parameters).compress(data)


def unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def steps(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Differences within stretches of rising numbers; each stretch starts from 0."""
    out = np.diff(values, prepend=values.dtype.type(0))
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    out[starts] = values[starts]
    return out


def walks(differences: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers that `steps` was made of."""
    total = np.cumsum(differences)
    before = np.concatenate((total[:0], [0], total)).astype(total.dtype)[np.cumsum(lengths) - lengths]
    return total - np.repeat(before, lengths)


def stretch_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches; empty ones are 0."""
    ends = np.cumsum(lengths)
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[ends - lengths]
