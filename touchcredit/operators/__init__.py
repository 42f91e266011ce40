"""Skew-tolerant building blocks composed from native DataFrame operators."""

from touchcredit.operators.asof import asof_forward  # noqa: F401
from touchcredit.operators.joins import left_lookup, not_in  # noqa: F401
from touchcredit.operators.positions import ordered_positions  # noqa: F401
from touchcredit.operators.topk import top1  # noqa: F401
