"""Imports every plan module so their queries register, and exposes the registry."""

from __future__ import annotations

import importlib

from tillbook.plans.registry import ORACLES, QUERIES

_MODULES = (
    "tillbook.plans.shop",
    "tillbook.plans.sportsbook",
    "tillbook.plans.locks",
    "tillbook.plans.relations",
    "tillbook.plans.quality",
    "tillbook.plans.metrics",
    "tillbook.plans.shop_jobs",
    "tillbook.plans.book_jobs",
    "tillbook.plans.checkout",
    "tillbook.plans.settlement",
    "tillbook.streaming.queries",
    "tillbook.streaming.live",
    "tillbook.plans.io",
    "tillbook.plans.builds",
    "tillbook.plans.shop_build",
    "tillbook.plans.book_build",
    "tillbook.plans.engagement",
    "tillbook.plans.money_build",
    "tillbook.plans.accounts",
)


def load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def queries():
    load()
    return dict(QUERIES)


def oracles():
    load()
    return dict(ORACLES)
