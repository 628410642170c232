"""All queries of the subpackage (importing this module registers them)."""

from __future__ import annotations

from . import q_bundles, q_copies, q_lists, q_pieces, q_scores  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
