"""All queries of this package and the SQL that checks them."""

from plumbline.llm import chats, hard_negatives, html_text, licences, merkle, near_copies, neighbours, packing, pieces, quality, sharding, token_counts, toxicity  # noqa: F401
from plumbline.llm.base import QUERIES, SQL  # noqa: F401
