"""Hand-written match documents (the raw format: info + innings/overs/deliveries)."""

import json
import os


def ball(batter, non_striker, bowler, bat=0, extras=None, wickets=None):
    extras = extras or {}
    n_extra = sum(v for v in extras.values() if v)
    d = {"batter": batter, "non_striker": non_striker, "bowler": bowler,
         "runs": {"batter": bat, "extras": n_extra, "total": bat + n_extra}}
    if extras:
        d["extras"] = extras
    if wickets:
        d["wickets"] = [{"player_out": p, "kind": k} for p, k in wickets]
    return d


B2 = 'Zoë "Z"'   # non-ASCII and quoted name


def match_1001(short_second_innings=False):
    inn0 = [
        ball("a1", "a2", "b1", 1),
        ball("a2", "a1", "b1", 0, {"wides": 1}),
        ball("a2", "a1", "b1", 4),
        ball("a2", "a1", "b1", 0, {"noballs": 1}),
        ball("a2", "a1", "b1", 0, wickets=[("a2", "caught")]),
        ball("a3", "a1", "b1", 0, {"byes": 1}),
        ball("a1", "a3", "b1", 0, wickets=[("a3", "run out")]),
    ]
    inn1 = [
        ball("b1", B2, "a1", 2),
        ball("b1", B2, "a1", 0, wickets=[("b1", "bowled"), (B2, "run out")]),
        ball("b3", B2, "a1", 1),
    ]
    if short_second_innings:
        inn1 = inn1[:1]
    return {
        "meta": {"data_version": "1.0.0"},
        "info": {
            "match_type": "T20", "gender": "male", "dates": ["2025-03-01"],
            "venue": "Eden Gardens", "city": "Kolkata",
            "event": {"name": "Test Cup", "match_number": 1},
            "toss": {"winner": "A", "decision": "bat"},
            "outcome": {"winner": "A", "by": {"runs": 5}},
            "player_of_match": ["a1"], "teams": ["A", "B"],
            "players": {"A": ["a1", "a2", "a3"], "B": ["b1", B2, "b3"]},
            "registry": {"people": {"a1": "id-a1", "a2": "id-a2", "a3": "id-a3",
                                    "b1": "id-b1", B2: "id-b2"}},
        },
        "innings": [
            {"team": "A", "overs": [{"over": 0, "deliveries": inn0}]},
            {"team": "B", "overs": [{"over": 0, "deliveries": inn1}]},
        ],
    }


def match_no_overs():
    m = match_1001()
    del m["innings"][1]["overs"]
    return m


def match_super_over_tie():
    m = match_1001()
    m["info"]["outcome"] = {"result": "tie"}
    m["info"]["toss"] = {}
    m["info"]["venue"] = "New Ground"
    m["info"]["city"] = ""
    m["innings"].append({"team": "A", "super_over": True, "overs": [
        {"over": 0, "deliveries": [ball("a1", "a2", "b1", 6)]}]})
    m["innings"].append({"team": "B", "super_over": True, "overs": [
        {"over": 0, "deliveries": [ball("b1", B2, "a1", 4)]}]})
    return m


def write(directory, name, doc):
    os.makedirs(directory, exist_ok=True)
    with open(os.path.join(directory, name), "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False)
