"""Column functions: no DataFrame, no action."""

from linkrank.functions.markup import (
    after_body_tag,
    closes_body,
    has_open_body,
    has_title,
    link_targets,
    normalise_title,
    page_body,
    page_title,
)
from linkrank.functions.score import contribution, damped_rank, initial_rank
from linkrank.functions.tokens import from_token, to_token

__all__ = [
    "after_body_tag",
    "closes_body",
    "contribution",
    "damped_rank",
    "from_token",
    "has_open_body",
    "has_title",
    "initial_rank",
    "link_targets",
    "normalise_title",
    "page_body",
    "page_title",
    "to_token",
]
