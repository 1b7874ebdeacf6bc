"""A direct sequential model of keyword resolution (one row at a time, the
graph updated after each row), used as the brute-force check for the Spark
operator.  Where several nodes match, the lowest node ordinal wins."""

from __future__ import annotations


def fold(existing, incoming):
    """existing: list of dict(name, alias, link, categories) in ordinal order.
    incoming: list of dict(pos, name, alias, link, categories) in any order.
    Returns (actions {pos: (action, node_name)}, nodes [dict]) ."""
    nodes = [dict(name=e["name"], alias=list(e["alias"] or []) if e["alias"] is not None else None,
                  link=e["link"], categories=list(e["categories"]) if e["categories"] is not None else None,
                  n_merged=0) for e in existing]
    actions = {}
    for r in sorted(incoming, key=lambda r: r["pos"]):
        name, aliases = r["name"], list(r["alias"] or [])
        if name is None:
            continue
        terms = [name.lower().strip()] + [a.lower().strip() for a in aliases if a]
        hit = None
        for i, k in enumerate(nodes):
            if k["name"] is None:
                continue
            if k["name"].lower() in terms or any(a is not None and a.lower() in terms for a in (k["alias"] or [])):
                hit = i
                break
        if hit is None:
            nodes.append(dict(name=name, alias=list(aliases), link=r["link"],
                              categories=list(r["categories"] or []), n_merged=0))
            actions[r["pos"]] = ("created", name)
            continue
        k = nodes[hit]
        cur = list(k["alias"] or [])
        new = [name] + aliases

        def not_in(a, lst):
            if a is None:
                return False
            if a in lst:
                return False
            return not any(x is None for x in lst)   # Cypher: a IN [.., null] is null
        k["alias"] = cur + [a for a in new if not_in(a, cur)]
        if k["link"] is None or k["link"] == "":
            k["link"] = r["link"]
        cc = list(k["categories"] or [])
        k["categories"] = cc + [c for c in (r["categories"] or []) if not_in(c, cc)]
        k["n_merged"] += 1
        actions[r["pos"]] = ("merged", k["name"])
    return actions, nodes
