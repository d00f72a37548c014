"""What the operators share: tables in the shared folder, ranks without hot tasks, and single evaluation."""

from __future__ import annotations

from parkwright.functions.text import let
from parkwright.operators.ranking import grouped_rank
from parkwright.sources.shared import BROADCAST_ROWS, cut, new_path, settled, shared_root, slices, small

__all__ = ["BROADCAST_ROWS", "cut", "grouped_rank", "let", "new_path", "settled", "shared_root", "slices", "small"]
