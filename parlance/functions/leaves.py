"""Leaves of a result's params and their equality (P9, J3, A21), as Python has them.

The texts are read by ``json.loads``: later duplicates of a key win, ``NaN`` and
``Infinity`` are numbers, integers keep all digits and floats are doubles; a
text that it cannot read (or whose integer exceeds Python's digit limit) has no
params. Objects are walked in order to dotted paths, whatever their depth; of
leaves with one path the later counts; empty objects have no leaf. Lists are
leaves compared by their Python text, so ``2`` and ``2.0`` differ inside one and
key order counts; other values compare by ``==`` (``True == 1 == 1.0``).
"""

from __future__ import annotations

import json

import pyarrow as pa

#: Kinds of values; ``bool`` stands before ``int``, whose kind it would be too.
KINDS = ((bool, "BOOLEAN"), (int, "INT"), (float, "FLOAT"), (str, "STRING"), (list, "ARRAY"), (type(None), "NULL"))


def params_of(text: str | None) -> dict | None:
    """The params of a result text, empty where it has none; null where either is no JSON object."""
    try:
        result = json.loads(text or "")
    except (ValueError, RecursionError):
        return None
    params = result.get("params", {}) if isinstance(result, dict) else None
    return params if isinstance(params, dict) else None


def leaves(params: dict) -> dict:
    """Path -> value of every leaf, in order."""
    out, path = {}, [("", iter(params.items()))]
    while path:
        prefix, members = path[-1]
        key, value = next(members, (None, None))
        if key is None:
            path.pop()
            continue
        at = f"{prefix}.{key}" if prefix else key
        if isinstance(value, dict):
            path.append((at, iter(value.items())))
        else:
            out[at] = value
    return out


def equal(x, y) -> bool:
    if isinstance(x, list) or isinstance(y, list):
        x, y = (str(v) if isinstance(v, list) else v for v in (x, y))
    return x == y


def kind(value) -> str:
    return next(name for t, name in KINDS if isinstance(value, t))


def shown(text: str) -> str:
    """Text that Arrow can hold: a lone surrogate as its escape."""
    return text.encode("utf-8", "backslashreplace").decode()


def key(value) -> str:
    """The value as text, the same for equal numbers: ``n:`` numbers, ``s:`` strings, ``l:`` lists, ``null``."""
    if value is None:
        return "null"
    if isinstance(value, str):
        return shown(f"s:{value}")
    if isinstance(value, list):
        return shown("l:" + json.dumps(value, ensure_ascii=False, separators=(",", ":")))
    whole = isinstance(value, int) or value.is_integer()
    return f"n:{int(value) if whole else value}"


def both(pred: str | None, ref: str | None) -> tuple[dict, dict]:
    """The leaves of a pair; none where either text has no params."""
    sides = params_of(pred), params_of(ref)
    return ({}, {}) if None in sides else tuple(leaves(s) for s in sides)


def count_pairs(pred: pa.Array, ref: pa.Array) -> pa.Array:
    """Per pair of texts: how many leaves are equal, predicted and in the reference."""
    counts = []
    for p, r in zip(pred.to_pylist(), ref.to_pylist(), strict=True):
        x, y = both(p, r)
        counts.append({"correct": sum(k in y and equal(v, y[k]) for k, v in x.items()), "predicted": len(x), "reference": len(y)})
    return pa.array(counts, pa.struct([(n, pa.int64()) for n in ("correct", "predicted", "reference")]))


def flat_batches(batches):
    """Rows of (ids, text) -> (ids, path, kind, key) of every leaf."""
    for batch in batches:
        found = [(i, *leaf) for i, t in enumerate(batch.columns[-1].to_pylist()) for leaf in leaves(params_of(t) or {}).items()]
        at = pa.array([i for i, _, _ in found], pa.int64())
        made = ([shown(p) for _, p, _ in found], [kind(v) for _, _, v in found], [key(v) for _, _, v in found])
        columns = [*(c.take(at) for c in batch.columns[:-1]), *(pa.array(m, pa.string()) for m in made)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "path", "kind", "vkey"])


def matched_batches(batches):
    """Rows of (id, pred, ref) -> (id, path, pkey, rkey, equal) of every path of either side."""
    for batch in batches:
        rows, made = [], []
        for i, (p, r) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            x, y = both(p, r)
            for path in x | y:
                rows.append(i)
                keys = (key(s[path]) if path in s else None for s in (x, y))
                made.append((shown(path), *keys, path in x and path in y and equal(x[path], y[path])))
        path, pkey, rkey, same = zip(*made, strict=True) if made else ((),) * 4
        strings = (pa.array(c, pa.string()) for c in (path, pkey, rkey))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), *strings, pa.array(same, pa.bool_())], [batch.schema.names[0], "path", "pkey", "rkey", "equal"]
        )
