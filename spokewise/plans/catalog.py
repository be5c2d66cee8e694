"""All registered queries, imported once so their ``@register`` decorators run."""

from __future__ import annotations

from spokewise.plans.registry import REGISTRY, Entry

_LOADED = False


def entries() -> dict[str, Entry]:
    global _LOADED
    if not _LOADED:
        from spokewise.plans import q_analytics, q_sources, q_streaming, q_tables  # noqa: F401
        _LOADED = True
    return dict(REGISTRY)
