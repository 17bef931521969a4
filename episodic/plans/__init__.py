"""Registered queries. Importing this package registers all of them."""

from episodic.plans import (episodes, experience, feedback, files, lifecycle, marts, mirrors, ranks, streams,  # noqa: F401
                            relational, targets, worklists)
from episodic.plans.registry import REGISTRY, register  # noqa: F401
