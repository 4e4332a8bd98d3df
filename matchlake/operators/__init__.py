"""Relational operators built from DataFrame primitives."""

from .topk import top_k_per_group  # noqa: F401
from .sides import two_sided_unpivot  # noqa: F401
from .writes import dedupe_batch, insert_ignore, upsert  # noqa: F401
from .quality import check_violations, key_violations, orphan_facts  # noqa: F401
