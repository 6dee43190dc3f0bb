"""Plan inspection and measured comparisons of strategies, formats and API forms."""

from metrolens.plans.explain import executed_join_nodes, plan_text
from metrolens.plans.metrics import Moved, NodeRun, moved, node_runs
from metrolens.plans.reports import (
    api_report,
    conversion_report,
    format_report,
    measure,
    run_once,
    strategy_report,
    variant_report,
)

__all__ = [
    "executed_join_nodes", "plan_text", "Moved", "NodeRun", "moved", "node_runs", "api_report", "conversion_report", "format_report", "measure", "run_once",
    "strategy_report", "variant_report",
]
