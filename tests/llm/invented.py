"""Invented texts for the tests of this folder."""

import random


def prose(seed, n):
    """Invented sentences: lines of ten to twenty words that end with a full stop."""
    rng = random.Random(seed)
    parts = ["th", "er", "in", "ou", "an", "sta", "ble", "ré", "ung", "el"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]
    lines = []
    while words:
        k = rng.randint(10, 20)
        lines.append(" ".join(words[:k]).capitalize() + ".")
        words = words[k:]
    return "\n".join(lines)
