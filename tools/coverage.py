"""Map SURVEY section-2 operator IDs to the registered queries that exercise them."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ALL = {"A": 13, "B": 22, "C": 14, "D": 26, "E": 15, "F": 17, "G": 5, "H": 7, "I": 37, "J": 4, "K": 32,
       "L": 4, "M": 7}


def ids_of(ops: str) -> set[str]:
    out = set()
    for a, b in re.findall(r"\b([A-M]\d+)(?:-([A-M]?\d+))?\b", ops):
        if b:
            letter = a[0]
            lo, hi = int(a[1:]), int(b.lstrip(letter))
            out |= {f"{letter}{i}" for i in range(lo, hi + 1)}
        else:
            out.add(a)
    return out


def main():
    from episodic.plans.registry import REGISTRY
    import episodic.plans  # noqa: F401
    cov: dict[str, list[str]] = {}
    for q in REGISTRY.values():
        for i in ids_of(q.ops):
            cov.setdefault(i, []).append(q.name)
    missing = [f"{k}{i}" for k, n in ALL.items() for i in range(1, n + 1) if f"{k}{i}" not in cov]
    if "--table" in sys.argv:
        for k, n in ALL.items():
            for i in range(1, n + 1):
                key = f"{k}{i}"
                print(f"| {key} | {', '.join(sorted(cov.get(key, []))) or '-'} |")
    print("missing:", missing)


if __name__ == "__main__":
    main()
