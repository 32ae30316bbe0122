"""JSON texts: canonical form, overlay, deep merge, resolution of indexed tables, literals inside scripts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _load(x):
    try:
        return json.loads(x) if isinstance(x, str) else None
    except ValueError:
        return None


def _dump(x) -> str | None:
    return None if x is None else json.dumps(x, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def canonical(col: Column) -> Column:
    """JSON with sorted keys and without blanks; null for null, invalid JSON and JSON null."""
    return F.pandas_udf(_canonical, T.StringType())(col)


def _canonical(s: pd.Series) -> pd.Series:
    return s.map(lambda x: _dump(_load(x)))


def _deep(a, b):
    if isinstance(a, dict) and isinstance(b, dict):
        return {k: _deep(a[k], b[k]) if k in a and k in b else a.get(k, b.get(k)) for k in {*a, *b}}
    return b if a is None else a


def _deep_merge(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_dump(_deep(_load(x), _load(y))) for x, y in zip(a, b)], index=a.index)


def deep_merge(a: Column, b: Column) -> Column:
    """Canonical JSON of both texts merged at every level; ``a`` wins where both say something, its nulls don't."""
    return F.pandas_udf(_deep_merge, T.StringType())(a, b)


def compact(col: Column) -> Column:
    """A map<string, string> without null and empty values."""
    return F.map_filter(col, lambda k, v: v.isNotNull() & (v != ""))


def _resolve(table: list, at: int, seen: tuple = (), depth: int = 0):
    if not isinstance(at, int) or isinstance(at, bool) or at < 0 or at >= len(table) or at in seen or depth > 40:
        return None
    v = table[at]
    if isinstance(v, dict):
        return {k: _resolve(table, x, (*seen, at), depth + 1) for k, x in v.items()}
    if isinstance(v, list):
        if len(v) == 2 and v[0] in ("Reactive", "ShallowReactive", "Ref", "ShallowRef", "EmptyRef"):
            return _resolve(table, v[1], (*seen, at), depth + 1)
        return [_resolve(table, x, (*seen, at), depth + 1) for x in v]
    return v


def _indexed(s: pd.Series) -> pd.Series:
    def one(x):
        t = _load(x)
        return _dump(_resolve(t, 0)) if isinstance(t, list) and t else None

    return s.map(one)


def resolve_indexed(col: Column) -> Column:
    """JSON of the first entry of an indexed table, whose numbers inside objects and lists name other entries.

    References out of range, to an entry that holds them, or too deep are null; so is what is no table.
    """
    return F.pandas_udf(_indexed, T.StringType())(col)


def _literals(s: pd.Series, names: pd.Series) -> pd.Series:
    def one(text, name):
        if not isinstance(text, str) or not isinstance(name, str):
            return None
        at = text.find(name)
        while at >= 0:
            i = at + len(name)
            while i < len(text) and text[i] in " \t\r\n=:(":
                i += 1
            if i < len(text) and text[i] in "{[":
                try:
                    value, _ = json.JSONDecoder().raw_decode(text, i)
                    return _dump(value)
                except ValueError:
                    pass
            at = text.find(name, at + 1)
        return None

    return pd.Series([one(a, b) for a, b in zip(s, names)], index=s.index)


def script_literal(text: Column, name: str | Column) -> Column:
    """The JSON object or list that stands behind a name in a script's text; null if there is none that is JSON."""
    return F.pandas_udf(_literals, T.StringType())(text, F.lit(name) if isinstance(name, str) else name)
