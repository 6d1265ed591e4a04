"""The warehouse reports: functions from named tables to a lazy ``DataFrame``.

``tables`` is any mapping from the names in ``quayside.sources.SCHEMAS`` to frames.
"""

from quayside.plans.cartons import cartons
from quayside.plans.gate_putaway import gate_putaway
from quayside.plans.loadlist import loadlist, loadlist_container, loadlist_open
from quayside.plans.offload import offload
from quayside.plans.prepack_in import prepack_in, prepack_in_archive, prepack_in_live
from quayside.plans.prepack_out import prepack_out
from quayside.plans.stock_weight import stock_weight

REPORTS = {
    "prepack_in": prepack_in,
    "prepack_out": prepack_out,
    "gate_putaway": gate_putaway,
    "offload": offload,
    "cartons": cartons,
    "stock_weight": stock_weight,
    "loadlist": loadlist,
}

__all__ = [
    "REPORTS",
    "cartons",
    "gate_putaway",
    "loadlist",
    "loadlist_container",
    "loadlist_open",
    "offload",
    "prepack_in",
    "prepack_in_archive",
    "prepack_in_live",
    "prepack_out",
    "stock_weight",
]
