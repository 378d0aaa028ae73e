"""Deletes carried down the foreign keys of a set of tables (O-Q4, O-V7, O-V8).

A graph names, for each table, the tables that its rows refer to and by which
columns.  Removed keys go down level by level: a table loses the rows that refer
to a removed row above it, one anti-join on the keys a reference, and what it
loses is removed for the tables below.  Tables are walked in load order, parents
first, so every table is joined once for each of its references.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from gtfsforge.operators.first import union_all

VERSION_KEY = ["version", "dataownercode"]
SCHED_KEY = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]
STOP_KEY = ["version", "dataownercode", "userstopcode"]
PATTERN_KEY = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode"]

# Which table's rows refer to which other table by which columns (KV1, PAS).
KV1_GRAPH = {
    "dest": [("version", VERSION_KEY)],
    "line": [("version", VERSION_KEY)],
    "point": [("version", VERSION_KEY)],
    "usrstar": [("version", VERSION_KEY)],
    "usrstop": [("version", VERSION_KEY)],
    "jopa": [("version", VERSION_KEY), ("line", ["version", "dataownercode", "lineplanningnumber"])],
    "jopatili": [("version", VERSION_KEY), ("jopa", PATTERN_KEY), ("dest", ["version", "dataownercode", "destcode"])],
    "excopday": [("version", VERSION_KEY)],
    "pegrval": [("version", VERSION_KEY)],
    "tive": [("version", VERSION_KEY)],
    "timdemgrp": [("version", VERSION_KEY), ("jopa", PATTERN_KEY)],
    "timdemrnt": [("version", VERSION_KEY), ("timdemgrp", [*PATTERN_KEY, "timedemandgroupcode"])],
    "pujo": [("version", VERSION_KEY), ("timdemgrp", [*PATTERN_KEY, "timedemandgroupcode"])],
    "schedvers": [("version", VERSION_KEY)],
    "pujopass": [("version", VERSION_KEY), ("schedvers", SCHED_KEY), ("usrstop", STOP_KEY), ("jopa", PATTERN_KEY)],
    "schedpujo": [("version", VERSION_KEY), ("schedvers", SCHED_KEY), ("jopa", PATTERN_KEY)],
    "operday": [("version", VERSION_KEY), ("schedvers", SCHED_KEY)],
}
PAS_GRAPH = {"pujopass": [("stops", ["halteid"])]}


def load_order(graph: dict, names: Iterable[str]) -> list[str]:
    """The named tables, each after all that it refers to; tables outside the graph come first."""
    names = set(names)
    out: list[str] = []

    def visit(name: str, above: tuple[str, ...] = ()):
        if name in above:
            raise ValueError(f"{name} refers to itself")
        for parent, _ in graph.get(name, ()):
            visit(parent, (*above, name))
        if name in names and name not in out:
            out.append(name)

    for name in [*sorted(names - set(graph)), *graph]:
        visit(name)
    return out


def cascade_all(tables: dict[str, DataFrame], graph: dict, gone: dict[str, DataFrame], removed: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The rows that stay of every table.

    gone: keys whose rows a table loses to begin with (all columns of the frame
    are compared).  removed: rows that a table, present or not, has lost already.
    """
    removed = dict(removed or {})
    kept = {}
    used = {parent for refs in graph.values() for parent, _ in refs}
    for name in load_order(graph, tables):
        df = tables[name]
        keys = [(removed[parent].select(*on).distinct(), on) for parent, on in graph.get(name, ()) if parent in removed and set(on) <= set(df.columns)]
        if name in gone:
            keys.append((gone[name].distinct(), gone[name].columns))
        kept[name] = df
        for k, on in keys:
            kept[name] = kept[name].join(k, on, "left_anti").select(*df.columns)
        if keys and name in used:
            lost = union_all(*[df.join(k, on, "left_semi").select(*df.columns) for k, on in keys])
            removed[name] = union_all(removed[name], lost) if name in removed else lost
    return kept
