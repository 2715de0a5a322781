"""Made-up texts."""

import random


def words(n, seed=0, letters="abcdefghijklmnopqrstuvwxyz"):
    """Words that repeat seldom."""
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)]
