"""Arguments with which each report runs on the sample tables."""

from __future__ import annotations

from datetime import date, datetime

SITE = "S1"
CLIENT = "C1"
SINCE = date(1999, 1, 1)
AS_OF = datetime(2022, 1, 2, 8, 0, 0)

_LOADLIST = {
    "site": SITE,
    "client": CLIENT,
    "loc_type": "ShipDock",
    "zones": ["DOCK-A", "DOCK-B"],
    "excluded_docks": ["SCRAP", "RETURN"],
    "as_of": AS_OF,
}

_PREPACK_IN = {"site": SITE, "client": CLIENT, "conditions": ["PPACK", "KIT"], "code": "Receipt"}

ARGUMENTS: dict[str, dict] = {
    "prepack_in": _PREPACK_IN,
    "prepack_in_live": _PREPACK_IN,
    "prepack_in_archive": _PREPACK_IN,
    "prepack_out": {"site": SITE, "client": CLIENT, "work_group_prefix": "800", "consignment": "SHP-A"},
    "gate_putaway": {
        "site": SITE,
        "gates": ["E3", "H9"],
        "from_locs": ["TR-1", "TR-2", "TR-3"],
        "since": SINCE,
    },
    "offload": {"site": SITE, "from_locs": ["TR-1", "TR-2", "TR-3", "KIT-1"], "since": SINCE},
    "cartons": {"site": SITE, "types": ["71", "72", "73", "74"], "since": SINCE},
    "stock_weight": {"site": SITE, "client": CLIENT},
    "loadlist_open": _LOADLIST,
    "loadlist_container": _LOADLIST,
    "loadlist": _LOADLIST,
}
