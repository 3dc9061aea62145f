"""Records as clients send them: six app logs of the six shapes, a change and a rule change."""

import json


def _common(device: int, is_new: str, system: str) -> dict:
    return {
        "ar": f"r{device % 7}", "ba": f"maker{device}", "ch": "shop", "is_new": is_new, "md": f"maker{device} two",
        "mid": f"device-{device}", "os": system, "uid": str(1000 + device), "vc": "v9.0.1",
    }


def _displays(n: int) -> list[dict]:
    return [{"display_type": "list", "item": str(50 + i), "item_type": "id", "order": i, "pos_id": 2} for i in range(1, n + 1)]


def _action(name: str, item: str, ts: int) -> dict:
    return {"action_id": name, "item": item, "item_type": "id", "ts": ts}


_NOON = 1700000000000
_START = {"entry": "widget", "loading_time": 900, "open_ad_id": 3, "open_ad_ms": 450, "open_ad_skip_ms": 120}
_ERROR = {"error_code": 4242, "msg": ' failed in thread \\ Timeout\n \tat "some.Place"(Place:1)'}
_PAGE = {"during_time": 777, "item": "51", "item_type": "id", "last_page_id": "before", "page_id": "here", "source_type": "link"}

APP_LOGS = [
    json.dumps(record, separators=(",", ":"))
    for record in (
        # a start
        {"common": _common(1, "1", "A 1"), "start": _START, "ts": _NOON},
        # a start with an error
        {"common": _common(2, "1", "A 2"), "err": _ERROR, "start": _START, "ts": _NOON + 1},
        # a page with displays and actions
        {"actions": [_action("like", "51", _NOON + 5), _action("share", "52", _NOON + 6)], "common": _common(1, "1", "A 1"),
         "displays": _displays(9), "page": _PAGE, "ts": _NOON + 2},
        # a page with displays
        {"common": _common(1, "1", "A 1"), "displays": _displays(8), "page": {"during_time": 5, "page_id": "home"}, "ts": _NOON + 3},
        # a page with all of it and an error
        {"actions": [_action("share", "53", _NOON + 9)], "common": _common(3, "0", "B 3"), "displays": _displays(9), "err": _ERROR,
         "page": _PAGE, "ts": _NOON + 4},
        # a bare page
        {"common": _common(3, "0", "B 3"), "page": {"during_time": 6, "last_page_id": "here", "page_id": "end"}, "ts": _NOON + 7},
    )
]

CHANGE = json.dumps(
    {"database": "shop", "table": "maker", "type": "insert", "ts": 1700000000, "xid": 12, "commit": True,
     "data": {"id": 8, "name": "two", "logo": "/logo/8"}}
)

RULE_CHANGE = json.dumps(
    {"before": None, "after": {"source_table": "from_here", "sink_table": "to_there", "sink_columns": "label,id", "sink_pk": "id",
     "sink_extend": "more"}, "source": {"table": "rules", "snapshot": "false"}, "op": "r", "ts_ms": 1700000000001}
)
