"""Baseline bands of a page: running-median clustering of token bottoms, a common slope, and merging of split bands.

Each step depends on the bands made before it, so a page is one group. Pages are independent, so the work is
spread by page.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.operators.geometry import BASELINE_LEAST, BASELINE_MOST, BASELINE_SHARE, RunningMedians
from gridledger.operators.keys import by_document, key_type

# Which bands may vote on the page's slope, and when two bands are one.
VOTE_TOKENS, VOTE_SPAN_PT, VOTE_SPAN_SHARE, VOTE_SPAN_RELAXED = 3, 150.0, 0.3, 60.0
VOTE_RANGE, VOTE_SLOPE, VOTE_RESIDUAL_SHARE = 0.25, 0.02, 0.25
CONSENSUS_LEAST, CONSENSUS_MADS, ACCEPT_BANDS, ACCEPT_MAD, SURE_BANDS = 0.0015, 3.0, 3, 0.0025, 6
MERGE_OVERLAP, MERGE_SPAN, MERGE_SLOPE, MERGE_MAD_SHARE = 0.5, 150.0, 0.018, 0.5


@dataclass
class Band:
    rows: list[int]
    centre: float


@dataclass(frozen=True)
class Slope:
    value: float = 0.0
    confidence: float = 0.0
    accepted: bool = False


def _mad(values) -> float:
    m = median(values)
    return median([abs(v - m) for v in values])


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Least squares slope and intercept; without spread in x the slope is 0."""
    if len(x) < 2 or np.ptp(x) == 0:
        return 0.0, float(y.mean()) if len(y) else 0.0
    d = x - x.mean()
    slope = float((d * (y - y.mean())).sum() / (d * d).sum())
    return slope, float(y.mean() - slope * x.mean())


def in_order(bands: list[Band], left: np.ndarray) -> list[Band]:
    return sorted(bands, key=lambda b: (b.centre, left[b.rows].min()))


def clustered(level: np.ndarray, left: np.ndarray, ids: np.ndarray, bottom: np.ndarray, tolerance: float) -> list[Band]:
    """Tokens in order of corrected bottom, left edge and id, each to the nearest band within tolerance, the oldest of equals."""
    medians = RunningMedians()
    rows: list[list[int]] = []
    for i in np.lexsort((bottom, ids, left, level)).tolist():
        k = medians.add(float(level[i]), tolerance)
        if k == len(rows):
            rows.append([])
        rows[k].append(i)
    return in_order([Band(r, c) for r, c in zip(rows, medians.centres)], left)


def consensus(bands: list[Band], x: np.ndarray, y: np.ndarray, least_span: float, tolerance: float) -> Slope:
    """The slope that enough long, straight bands agree on; how sure it is grows with their number and their agreement."""
    slopes = []
    for b in bands:
        bx, by = x[b.rows], y[b.rows]
        if len(b.rows) < VOTE_TOKENS or np.ptp(bx) < least_span or np.ptp(by) < VOTE_RANGE:
            continue
        slope, at = fit(bx, by)
        if abs(slope) <= VOTE_SLOPE and _mad(np.abs(by - slope * bx - at).tolist()) <= VOTE_RESIDUAL_SHARE * tolerance:
            slopes.append(slope)
    if not slopes:
        return Slope()
    m, radius = median(slopes), max(CONSENSUS_LEAST, CONSENSUS_MADS * _mad(slopes))
    agreeing = [s for s in slopes if abs(s - m) <= radius]
    value, spread = median(agreeing), _mad(agreeing)
    if len(agreeing) < ACCEPT_BANDS or spread > ACCEPT_MAD or abs(value) > VOTE_SLOPE:
        return Slope()
    return Slope(value, min(1.0, len(agreeing) / SURE_BANDS) * max(0.0, 1.0 - spread / ACCEPT_MAD), True)


def page_slope(cluster, x: np.ndarray, y: np.ndarray, width: float, tolerance: float) -> Slope:
    """A strict vote over level bands; if that fails, a relaxed one, whose slope makes longer bands for a second strict one.
    cluster gives the bands for a slope."""
    strict = max(VOTE_SPAN_PT, VOTE_SPAN_SHARE * width)
    level = cluster(0.0)
    found = consensus(level, x, y, strict, tolerance)
    if found.accepted:
        return found
    relaxed = consensus(level, x, y, VOTE_SPAN_RELAXED, tolerance)
    if not relaxed.accepted:
        return found
    refined = consensus(cluster(relaxed.value), x, y, strict, tolerance)
    return refined if refined.accepted else relaxed


def _joined(a: Band, b: Band, box: np.ndarray, x: np.ndarray, y: np.ndarray, tolerance: float, middle: float) -> Band | None:
    """Two neighbouring bands as one, if no token of one lies over a token of the other, they stand well apart, and the line
    through their middles is nearly level and both keep to it."""
    left, right = np.maximum.outer(box[a.rows, 0], box[b.rows, 0]), np.minimum.outer(box[a.rows, 2], box[b.rows, 2])
    if (right - left > MERGE_OVERLAP).any():
        return None
    (ax, ay), (bx, by) = ((median(x[r].tolist()), median(y[r].tolist())) for r in (a.rows, b.rows))
    if abs(bx - ax) < MERGE_SPAN:
        return None
    slope = (by - ay) / (bx - ax)
    if abs(slope) > MERGE_SLOPE or any(_mad(y[r].tolist()) > MERGE_MAD_SHARE * tolerance for r in (a.rows, b.rows)):
        return None
    rows = a.rows + b.rows
    return Band(rows, median((y[rows] - slope * (x[rows] - middle)).tolist()))


def reconciled(bands: list[Band], box: np.ndarray, x: np.ndarray, y: np.ndarray, tolerance: float, middle: float) -> list[Band]:
    """Neighbouring bands that lie side by side on one slightly sloped line merge, the topmost first, until none do.

    A pair that was looked at isn't looked at again while both stay as they are.
    """
    apart: set[tuple[int, int]] = set()
    kept = list(bands)  # keeps every band alive, so that no identity is given twice
    while True:
        for k, (a, b) in enumerate(zip(bands, bands[1:])):
            if (id(a), id(b)) in apart:
                continue
            both = _joined(a, b, box, x, y, tolerance, middle)
            if both:
                kept.append(both)
                bands = in_order([*bands[:k], both, *bands[k + 2 :]], box[:, 0])
                break
            apart.add((id(a), id(b)))
        else:
            return bands


def page_bands(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("token_id", kind="stable").reset_index(drop=True)
    box = pdf[["x0", "y0", "x1", "y1"]].to_numpy(float)
    ids = pdf["token_id"].to_numpy()
    x, y = (box[:, 0] + box[:, 2]) / 2, box[:, 3]
    tolerance = max(BASELINE_LEAST, min(BASELINE_MOST, BASELINE_SHARE * median((box[:, 3] - box[:, 1]).tolist())))
    width = float(pdf["page_width"].iloc[0]) if pdf["page_width"].notna().all() else float(box[:, 2].max())
    cluster = lambda slope: clustered(y - slope * (x - width / 2), box[:, 0], ids, y, tolerance)
    slope = page_slope(cluster, x, y, width, tolerance)
    bands = reconciled(cluster(slope.value), box, x, y, tolerance, width / 2)
    found = [(i, k, round(b.centre, 3)) for k, b in enumerate(bands) for i in sorted(b.rows)]
    at = [i for i, _, _ in found]
    out = pdf.loc[at, ["page", "token_id"]].reset_index(drop=True)
    return out.assign(band_id=[k for _, k, _ in found], baseline_y=[c for _, _, c in found], slope=round(slope.value, 6), confidence=round(slope.confidence, 4))


@by_document("page")
def baseline_bands(tokens: DataFrame, page_width: Column | None = None) -> DataFrame:
    """page, token_id, band_id, baseline_y, slope, confidence of all tokens. page_width: by default a page's rightmost edge."""
    rows = tokens.select("page", "token_id", "x0", "y0", "x1", "y1", (F.lit(None) if page_width is None else page_width).cast("double").alias("page_width"))
    schema = f"page {key_type(rows, 'page')}, token_id bigint, band_id bigint, baseline_y double, slope double, confidence double"
    return rows.groupBy("page").applyInPandas(page_bands, schema)


# ---- repair of shifted label and amount pairs --------------------------------------------------------------
# Fixed values of the repair, in points.
REPAIR_PAIRS, REPAIR_DELTA, CONTRADICTION, OVERLAP, MOST_GAP = 3, -0.5, 0.5, 3.0, 8.0


def repair_chains(pdf: pd.DataFrame) -> pd.DataFrame:
    """Chains of a page: each orphan amount takes the next label below it; a label that held one amount which
    lies below it hands that amount on, until a label is free.

    pdf: page, item_id, role (label or amount), y0, y1, claimed_by (label of a claimed amount, else null).
    """
    page = pdf["page"].iloc[0]
    labels = {int(r.item_id): r for r in pdf[pdf.role == "label"].itertuples()}
    amounts = {int(r.item_id): r for r in pdf[pdf.role == "amount"].itertuples()}
    claims: dict[int, list[int]] = {}
    for a in amounts.values():
        if not pd.isna(a.claimed_by):
            claims.setdefault(int(a.claimed_by), []).append(int(a.item_id))
    orphans = sorted((a.y1, int(a.item_id)) for a in amounts.values() if pd.isna(a.claimed_by))
    out, used = [], set()
    deltas = [amounts[a].y1 - labels[k].y1 for k, own in claims.items() for a in own if k in labels]
    if not orphans:
        gate = "no_orphans"
    elif len(deltas) < REPAIR_PAIRS:
        gate = "insufficient_convention_support"
    elif median(deltas) > REPAIR_DELTA:
        gate = "amounts_not_above_labels_convention"
    else:
        gate = None
    for _, orphan in orphans if gate is None else []:
        chain, amount, closed, seen = [], orphan, False, set(used)
        while True:
            bottom = amounts[amount].y1
            below = sorted((r.y0, k) for k, r in labels.items() if bottom - OVERLAP <= r.y0 <= bottom + MOST_GAP and k not in used)
            if not below or below[0][1] in seen:
                break
            label = below[0][1]
            seen.add(label)
            held = claims.get(label, [])
            if len(held) > 1 or (held and amounts[held[0]].y0 <= labels[label].y0 + CONTRADICTION):
                break
            chain.append((amount, label))
            if not held:
                closed = True
                break
            amount = held[0]
        if closed:
            used.update(k for _, k in chain)
        out += [(page, orphan, n, a, k, closed) for n, (a, k) in enumerate(chain)] or [(page, orphan, 0, orphan, None, False)]
    reason = gate or ("closed_chains_applied" if any(r[5] for r in out) else "no_closed_chains")
    rows = [(*r, reason) for r in out] or [(page, None, None, None, None, None, reason)]
    frame = pd.DataFrame(rows, columns=["page", "orphan_id", "step", "amount_id", "label_id", "closed", "reason"])
    return frame.astype({c: "Int64" for c in ("orphan_id", "step", "amount_id", "label_id")} | {"closed": "boolean"})


@by_document("page")
def chain_repair(items: DataFrame) -> DataFrame:
    """page, orphan_id, step, amount_id, label_id, closed, reason; pages without orphans or support only say why."""
    rows = items.select("page", "item_id", "role", "y0", "y1", "claimed_by")
    schema = f"page {key_type(rows, 'page')}, orphan_id bigint, step bigint, amount_id bigint, label_id bigint, closed boolean, reason string"
    return rows.groupBy("page").applyInPandas(repair_chains, schema)
