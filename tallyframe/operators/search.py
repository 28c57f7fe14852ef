"""Candidate tables for the searches (M19, M24; those of M22 and M23 are in ``hybrid``).

Candidates are bounded parameter lists built on the driver; the data work
of scoring them runs on Spark (see ``nb.search`` and the model plans).
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from itertools import product

ROLES = ("num", "text", "both")


def log_uniform(n: int, lo: float, hi: float, seed: int = 42) -> list[float]:
    r = random.Random(seed)
    return [round(math.exp(r.uniform(math.log(lo), math.log(hi))), 6) for _ in range(n)]


def role_candidates(questions: Sequence[str]) -> list[dict[str, list[str]]]:
    """Product of roles; each candidate is a fresh {role: [questions]}
    (K9: 'num' and 'both' feed the numeric list, 'text' and 'both' the text list)."""
    out = []
    for combo in product(ROLES, repeat=len(questions)):
        num = [q for q, r in zip(questions, combo) if r in ("num", "both")]
        txt = [q for q, r in zip(questions, combo) if r in ("text", "both")]
        out.append({"num": num, "text": txt})
    return out
