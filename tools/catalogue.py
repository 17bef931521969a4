"""Print README's query catalogue from the registry."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    import episodic.plans  # noqa: F401
    from episodic.plans.registry import REGISTRY
    print("| query | SURVEY section-2 ids |\n|---|---|")
    for q in REGISTRY.values():
        print(f"| `{q.name}` | {q.ops} |")


if __name__ == "__main__":
    main()
