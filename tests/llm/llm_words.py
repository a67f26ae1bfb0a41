"""Words and texts that the tests of this folder share."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(n))
