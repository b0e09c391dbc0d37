"""All registered plans: name -> Plan(run, oracle sql, ops)."""

from __future__ import annotations

import importlib

from retail_spark.plans.common import Plan

_MODULES = (
    "retail_spark.plans.silver_plans",
    "retail_spark.plans.gold_plans",
    "retail_spark.plans.business_plans",
    "retail_spark.plans.quality_plans",
    "retail_spark.plans.graph_plans",
    "retail_spark.plans.stream_plans",
)


def all_plans() -> dict[str, Plan]:
    plans: dict[str, Plan] = {}
    for name in _MODULES:
        for key, plan in importlib.import_module(name).PLANS.items():
            if key in plans:
                raise ValueError(f"duplicate plan {key}")
            plans[key] = plan
    return plans
