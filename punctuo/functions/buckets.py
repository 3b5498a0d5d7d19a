"""Delay / ttl bucket functions and integer-range helpers.

Buckets are computed as a small integer id inside the plans (cheap to
shuffle and to group on) and turned into the canonical range label
(``[0,1)``, ``(,-90)``, ``[91,)``, ``(,)``) only at the output edge.
The id is found with a balanced comparison tree, so a value costs about
log2(#buckets) comparisons inside generated code.
"""

from __future__ import annotations

import re
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these must equal the reference's bucket edges -------------
# delay_bucket_range: left edge inclusive, first and last bucket open-ended.
DELAY_CUTS = (-90, -75, -60, -45, -30, -25, -20, -15,
              -10, -9, -8, -7, -6, -5, -4, -3, -2, -1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11,
              16, 21, 26, 31, 46, 61, 76, 91)
# ttl_bucket_range: same convention.
TTL_CUTS = (-20, -15, -10, -5, 0, 5, 10, 15, 20, 25, 30, 45, 60, 75, 90, 120, 150, 180, 240, 300, 360)
# reduced_latest_sample_ttl_bucket_range: targets tried in this order.
REDUCED_TTL_TARGETS = ("(,-15)", "[-15,0)", "[0,15)", "[15,)")
# label of the unbounded range used for "cancelled, substitute running"
UNBOUNDED = "(,)"
# response_type_name knows these ids only
RESPONSE_TYPE_NAMES = {0: "journeys", 1: "departures", 2: "arrivals", 3: "trip", 4: "refreshJourney"}
# ------------------------------------------------------------------------------

SUBSTITUTE_ID = 127  # id reserved for the UNBOUNDED delay bucket


def labels_for(cuts) -> list[str]:
    """Canonical half-open labels for consecutive cut points."""
    out = [f"(,{cuts[0]})"]
    out += [f"[{a},{b})" for a, b in zip(cuts[:-1], cuts[1:])]
    out.append(f"[{cuts[-1]},)")
    return out


DELAY_LABELS = labels_for(DELAY_CUTS)
TTL_LABELS = labels_for(TTL_CUTS)


def _tree(col: Column, cuts, lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(col < F.lit(cuts[mid]), _tree(col, cuts, lo, mid)).otherwise(_tree(col, cuts, mid + 1, hi))


def bucket_id(col: Column, cuts) -> Column:
    """Index of the half-open bucket holding ``col``; NULL stays NULL."""
    return F.when(col.isNotNull(), _tree(col, cuts, 0, len(cuts)).cast("tinyint"))


def delay_bucket_id(col: Column) -> Column:
    return bucket_id(col, DELAY_CUTS)


def ttl_bucket_id(col: Column) -> Column:
    return bucket_id(col, TTL_CUTS)


def _label_of(idcol: Column, labels, extra: dict | None = None) -> Column:
    lab = F.try_element_at(F.array(*[F.lit(x) for x in labels]), idcol.cast("int") + F.lit(1))
    for k, v in (extra or {}).items():
        lab = F.when(idcol == F.lit(k), F.lit(v)).otherwise(lab)
    return lab


def delay_label(idcol: Column) -> Column:
    return _label_of(idcol, DELAY_LABELS, {SUBSTITUTE_ID: UNBOUNDED})


def ttl_label(idcol: Column) -> Column:
    return _label_of(idcol, TTL_LABELS)


def delay_bucket(col: Column) -> Column:
    """A1: ``delay_bucket_range(smallint)`` as a label."""
    return delay_label(delay_bucket_id(col))


def ttl_bucket(col: Column) -> Column:
    """A2: ``ttl_bucket_range(smallint)`` as a label."""
    return ttl_label(ttl_bucket_id(col))


# --- integer ranges ----------------------------------------------------------

_RANGE_RE = re.compile(r"^([\[(])(-?\d*),(-?\d*)([\])])$")


def parse_range(label: str | None):
    """Python side: label -> (lower, upper) in canonical [lower, upper); None = unbounded."""
    if label is None:
        return None
    m = _RANGE_RE.match(label)
    if not m:
        raise ValueError(f"not a range: {label}")
    lb, lo, hi, ub = m.groups()
    lo_v = int(lo) if lo != "" else None
    hi_v = int(hi) if hi != "" else None
    if lo_v is not None and lb == "(":
        lo_v += 1
    if hi_v is not None and ub == "]":
        hi_v += 1
    return lo_v, hi_v


def canonical(label: str) -> str:
    lo, hi = parse_range(label)
    return f"{'(' if lo is None else '['}{'' if lo is None else lo},{'' if hi is None else hi})"


def py_contained(inner: str | None, outer: str) -> bool | None:
    """Python side of the ``<@`` operator on canonical integer ranges."""
    if inner is None:
        return None
    ilo, ihi = parse_range(inner)
    olo, ohi = parse_range(outer)
    lo_ok = olo is None or (ilo is not None and ilo >= olo)
    hi_ok = ohi is None or (ihi is not None and ihi <= ohi)
    return lo_ok and hi_ok


def range_bounds(label: Column) -> Column:
    """Column side: label -> struct<lower:int, upper:int> (canonical, NULL = unbounded)."""
    pat = r"^([\[(])(-?\d*),(-?\d*)([\])])$"
    lb = F.regexp_extract(label, pat, 1)
    lo = F.regexp_extract(label, pat, 2)
    hi = F.regexp_extract(label, pat, 3)
    ub = F.regexp_extract(label, pat, 4)
    lo_v = F.when(lo != "", lo.cast("int") + F.when(lb == "(", 1).otherwise(0))
    hi_v = F.when(hi != "", hi.cast("int") + F.when(ub == "]", 1).otherwise(0))
    return F.when(label.isNotNull(), F.struct(lo_v.alias("lower"), hi_v.alias("upper")))


def contained_in(label: Column, outer: str) -> Column:
    """``label <@ outer`` for a literal outer range; NULL in, NULL out."""
    olo, ohi = parse_range(outer)
    b = range_bounds(label)
    lo_ok = F.lit(True) if olo is None else (b["lower"].isNotNull() & (b["lower"] >= F.lit(olo)))
    hi_ok = F.lit(True) if ohi is None else (b["upper"].isNotNull() & (b["upper"] <= F.lit(ohi)))
    return F.when(label.isNotNull(), lo_ok & hi_ok)


def reduced_ttl_bucket(label: Column) -> Column:
    """A3: first target range containing the bucket, else NULL."""
    out = F.lit(None).cast("string")
    for tgt in reversed(REDUCED_TTL_TARGETS):
        out = F.when(contained_in(label, tgt), F.lit(tgt)).otherwise(out)
    return out


def _reduced_for(label: str) -> str | None:
    for tgt in REDUCED_TTL_TARGETS:
        if py_contained(label, tgt):
            return tgt
    return None


# id-level form of A3 for the histogram path: ttl id -> reduced label
REDUCED_OF_TTL_ID = {i: _reduced_for(lab) for i, lab in enumerate(TTL_LABELS)}


def response_type_name(col: Column) -> Column:
    """A5: id -> name for the ids the lookup knows, NULL otherwise."""
    out = F.lit(None).cast("string")
    for k, v in RESPONSE_TYPE_NAMES.items():
        out = F.when(col == F.lit(k), F.lit(v)).otherwise(out)
    return out


def js_round(col: Column) -> Column:
    """N1 rounding: halves go up toward +infinity (not away from zero)."""
    return F.floor(col + F.lit(0.5))


def minutes_from_seconds(col: Column) -> Column:
    """Delay seconds -> minutes, rounded as above, NULL stays NULL (int: outliers are counted, not an error)."""
    return js_round(col / F.lit(60.0)).try_cast("int")
