"""Terms of texts: maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case."""

from __future__ import annotations

import numpy as np

from rillframe.llm.words import Texts

TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8) + 32 * np.isin(np.arange(256), np.arange(65, 91)).astype(np.uint8)


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in lower case, the spans of the terms, and where each row's first term is."""
    return LOWER[texts.data], *texts.parts(TERM[texts.data])

