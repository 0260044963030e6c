"""All registered queries; importing a plan module registers its queries."""

from __future__ import annotations

from pollwright.plans import files, prompts, registry, results, survey  # noqa: F401


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
