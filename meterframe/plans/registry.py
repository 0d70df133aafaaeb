"""Import every catalog module so its queries register, then expose them."""

from __future__ import annotations


def _load():
    from . import catalog  # noqa: F401
    from . import catalog_service  # noqa: F401
    from . import catalog_more  # noqa: F401
    from . import catalog_streaming  # noqa: F401

    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    _load()
    from .oracle import ORACLE

    return dict(ORACLE)
