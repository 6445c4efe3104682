"""Region and ocean labels of a position, as column expressions.

The boxes are a short fixed list, so a label is a chain of comparisons inside
whole-stage codegen: no join and no exchange. Box sets that are tables are joined
by floatlake.operators.regions instead.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, functions as F

from floatlake.catalog import OCEAN_BOXES, REGION_BOXES


def visible_boxes(boxes, mode: str = "closed"):
    """The boxes that can win: those not covered by the earlier ones together.

    A sweep over the latitudes. Between two edges, and on each edge, the same boxes hold a point
    whatever its exact place, so every edge and every gap is one row, with the longitudes
    (edges and gaps again) that earlier boxes cover as the bits of one number.
    """
    def places(low: int, high: int) -> list[tuple[float, float]]:
        edges = sorted({edge for box in boxes for edge in (box[low], box[high])})
        return sorted([(edge, edge) for edge in edges] + list(zip(edges, edges[1:])))

    def held(place: tuple[float, float], low: float, high: float) -> bool:
        # A gap reaches from edge to edge, so it is inside a box as a whole or not at all.
        if place[0] < place[1]:
            return low <= place[0] and place[1] <= high
        return low <= place[0] <= high if mode == "closed" else low < place[0] < high

    rows, columns = places(1, 2), places(3, 4)
    covered, kept = [0] * len(rows), []
    for box in boxes:
        _, south, north, west, east = box
        own = sum(1 << i for i, place in enumerate(columns) if held(place, west, east))
        within = [i for i, place in enumerate(rows) if held(place, south, north)]
        if any(own & ~covered[i] for i in within):
            kept.append(box)
        for i in within:
            covered[i] |= own
    return kept


@cache
def _region_boxes(mode: str):
    return visible_boxes(REGION_BOXES, mode)


def _missing(lat: str, lon: str) -> str:
    return f"{lat} IS NULL OR {lon} IS NULL OR isnan({lat}) OR isnan({lon})"


def _first_label(cases: list[tuple[str, str]], unknown: str) -> Column:
    """CASE expression over (condition, label) pairs; one SQL text, parsed once."""
    branches = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in cases)
    return F.expr(f"CASE {branches} ELSE '{unknown}' END")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def in_box(lat: Column, lon: Column, lat0, lat1, lon0, lon1, mode: str = "closed") -> Column:
    """Point in box, borders included (closed) or not (open)."""
    if mode == "closed":
        return (lat >= lat0) & (lat <= lat1) & (lon >= lon0) & (lon <= lon1)
    return (lat > lat0) & (lat < lat1) & (lon > lon0) & (lon < lon1)


def assign_region(lat: str, lon: str, mode: str = "closed") -> Column:
    """Name of the first region whose box holds the point, from two column names.

    closed includes the borders and answers "Unknown" for no match; open leaves the
    borders out and answers "Unknown Region".
    """
    if mode not in ("closed", "open"):
        raise ValueError(f"mode must be 'closed' or 'open', not {mode!r}")
    lat, lon = _quoted(lat), _quoted(lon)
    unknown, cmp = ("Unknown", "<=") if mode == "closed" else ("Unknown Region", "<")
    cases = [(_missing(lat, lon), unknown)]
    for name, lat0, lat1, lon0, lon1 in _region_boxes(mode):
        cases.append((
            f"{lat0}D {cmp} {lat} AND {lat} {cmp} {lat1}D"
            f" AND {lon0}D {cmp} {lon} AND {lon} {cmp} {lon1}D",
            name,
        ))
    return _first_label(cases, unknown)


def assign_ocean(lat: str, lon: str, mode: str = "boxes") -> Column:
    """Ocean of a point, by the ordered box list (boxes) or by latitude belts and
    longitude sectors (chain), from two column names."""
    lat, lon = _quoted(lat), _quoted(lon)
    if mode == "boxes":
        cases = [(_missing(lat, lon), "Unknown")]
        for name, lat0, lat1, lon0, lon1 in OCEAN_BOXES:
            link = "OR" if lon0 > lon1 else "AND"
            cases.append((
                f"{lat} BETWEEN {lat0} AND {lat1} AND ({lon} >= {lon0} {link} {lon} <= {lon1})",
                name,
            ))
        return _first_label(cases, "Unknown")
    if mode == "chain":
        # Belts first, then sectors; the first match wins.
        rules = [
            (_missing(lat, lon), "Unknown Ocean"),
            (f"{lat} >= 65", "Arctic Ocean"),
            (f"{lat} <= -60", "Southern Ocean"),
            (f"{lon} BETWEEN -70 AND 20", "Atlantic Ocean"),
            (f"{lon} BETWEEN 20 AND 147", "Indian Ocean"),
            (f"{lon} >= 120 OR {lon} <= -70", "Pacific Ocean"),
        ]
        return _first_label(rules, "Unknown Ocean")
    raise ValueError(f"mode must be 'boxes' or 'chain', not {mode!r}")
