"""Words for tests."""

import random


def words(n, seed, pool=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(pool)}x" for _ in range(n))
