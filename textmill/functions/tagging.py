"""Weighted keyword categories for chunks, as pure column expressions.

Each category's score is a left-to-right sum, in declared pattern order, of
``3*w*hits(title) + 1*w*hits(body)``; that order makes the doubles bit-equal
to a sequential accumulation.  The label is the highest score, ties going to
the category declared first, with ``General`` below a minimum score.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category names, patterns and weights, in declaration order
# (the order breaks ties).  Patterns are matched case-insensitively.
CATEGORY_RULES: list[tuple[str, list[tuple[str, float]]]] = [
    ("Non-Content", [
        (r"\b(table of contents|contents|toc|list of (tables|figures)|illustrations?|drawings?|schematics?)\b", 3.0),
    ]),
    ("Hydraulic", [
        (r"\bhydraul\w+\b", 3.0),
        (r"\b(actuator|reservoir|accumulator|servo|pressure|relief valve|hyd\.? pump)\b", 1.5),
    ]),
    ("Electrical", [
        (r"\belectrical?( system)?\b", 3.0),
        (r"\b(circuit(s)?|voltage|current|battery|generator|alternator|bus(bar)?|breaker|inverter)\b", 1.5),
    ]),
    ("Avionics", [
        (r"\b(avionics?|navigation|communication|radar|(fms|gps)\b|display|computer)\b", 1.5),
        (r"\bflight director\b", 3.0),
    ]),
    ("Powerplant", [
        (r"\b(powerplant|engine(s)?|turbine|compressor|combustion|exhaust|ignition|propeller)\b", 2.0),
        (r"\b(n1|n2|egt|itt|torque)\b", 1.2),
    ]),
    ("Landing Gear", [
        (r"\blanding gear\b", 3.0),
        (r"\b(strut|shock|brake(s)?|wheel(s)?|tire(s)?|nose gear|extend|retract)\b", 1.5),
    ]),
    ("Maintenance", [
        (r"\b(troubleshooting|inspection|intervals?|schedule|service|lubricat(e|ion)|maintenance)\b", 1.5),
        (r"\b(removal and installation|R&I|install(ation)?|remove)\b", 1.5),
    ]),
    ("Fuel System", [
        (r"\bfuel system\b", 3.0),
        (r"\b(fuel (tank|selector|quantity|indicator|flow)|boost pump|unfeather pump)\b", 1.8),
    ]),
    ("Environmental", [
        (r"\b(air conditioning|pressurization|bleed air|ventilation|temperature control|oxygen)\b", 2.0),
    ]),
    ("Flight Controls", [
        (r"\b(flight control|aileron|elevator|rudder|flap|spoiler|trim)\b", 1.8),
        (r"\b(autopilot|yaw damper)\b", 2.2),
    ]),
    ("Emergency Procedures", [
        (r"\b(emergency procedures?|abnormal|warning(s)?|caution(s)?)\b", 1.5),
    ]),
    ("Limitations", [
        (r"\b(limitations?|operating limits?|weight and balance|center of gravity|c\.?g\.?)\b", 1.8),
    ]),
    ("Operating Procedures", [
        (r"\b(normal procedures?|operational procedures?|checklist|preflight|postflight|start(ing)?|shutdown)\b", 1.5),
    ]),
]
# For each pattern above (same order), literal pieces of which
# every match contains at least one, in lower case.  Used only to skip the
# regex on texts that cannot match; the counts are the regex's.
CATEGORY_ANCHORS: list[list[tuple[str, ...]]] = [
    [("contents", "toc", "list of ", "illustration", "drawing", "schematic")],
    [("hydraul",),
     ("actuator", "reservoir", "accumulator", "servo", "pressure", "relief valve", "hyd")],
    [("electrica",),
     ("circuit", "voltage", "current", "battery", "generator", "alternator", "bus", "breaker", "inverter")],
    [("avionic", "navigation", "communication", "radar", "fms", "gps", "display", "computer"),
     ("flight director",)],
    [("powerplant", "engine", "turbine", "compressor", "combustion", "exhaust", "ignition", "propeller"),
     ("n1", "n2", "egt", "itt", "torque")],
    [("landing gear",),
     ("strut", "shock", "brake", "wheel", "tire", "nose gear", "extend", "retract")],
    [("troubleshooting", "inspection", "interval", "schedule", "service", "lubricat", "maintenance"),
     ("removal and installation", "r&i", "install", "remove")],
    [("fuel system",),
     ("fuel ", "boost pump", "unfeather pump")],
    [("air conditioning", "pressurization", "bleed air", "ventilation", "temperature control", "oxygen")],
    [("flight control", "aileron", "elevator", "rudder", "flap", "spoiler", "trim"),
     ("autopilot", "yaw damper")],
    [("emergency procedure", "abnormal", "warning", "caution")],
    [("limitation", "operating limit", "weight and balance", "center of gravity", "cg", "c.g")],
    [("normal procedure", "operational procedure", "checklist", "preflight", "postflight", "start", "shutdown")],
]

TITLE_WEIGHT = 3.0
BODY_WEIGHT = 1.0
MIN_SCORE = 2.0
FALLBACK = "General"

CATEGORIES = [name for name, _ in CATEGORY_RULES]


def score_column_name(category: str) -> str:
    """``Landing Gear`` -> ``score_landing_gear``."""
    return "score_" + re.sub(r"[^0-9a-z]+", "_", category.lower()).strip("_")


def _hits(c: Column, pattern: str) -> Column:
    # (?iU): case-insensitive, Unicode \b \w and case folding, as Python's re.I
    return F.regexp_count(c, F.lit("(?iU)" + pattern)).cast("double")


def folded(c: Column) -> Column:
    """Lower case plus the two letters whose case partner is ASCII but whose
    lower case is not (long s, dotless i): a case-insensitive match of an
    ASCII literal always appears in this text as that literal in lower case."""
    return F.translate(F.lower(c), "\u017f\u0131", "si")


def _hits_filtered(c: Column, fold: Column, pattern: str, anchors: tuple[str, ...]) -> Column:
    """Regex count, skipped (0) when the folded text holds none of the
    pattern's anchors; a substring test is far cheaper than the regex."""
    gate = None
    for a in anchors:
        hit = fold.contains(a)
        gate = hit if gate is None else (gate | hit)
    return F.when(gate, _hits(c, pattern)).otherwise(F.lit(0.0))


def category_score_columns(body, title=None, rules=None,
                           w_title: float = TITLE_WEIGHT,
                           w_body: float = BODY_WEIGHT, fold_col: str | None = None) -> list[Column]:
    """One double column per category, aliased ``score_<name>``.

    A null or empty ``title`` contributes nothing; a null body counts as ''.
    With ``fold_col`` (a column holding ``folded(body)``, see
    :func:`score_frame`) each body regex runs only on texts holding one of
    its anchors.
    """
    anchors = CATEGORY_ANCHORS if (rules is None and fold_col is not None) else None
    rules = CATEGORY_RULES if rules is None else rules
    b = F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit(""))
    bf = F.col(fold_col) if fold_col is not None else None
    t = None
    if title is not None:
        t = F.col(title) if isinstance(title, str) else title
    cols = []
    for ci, (name, pats) in enumerate(rules):
        acc = F.lit(0.0)
        for pi, (pat, w) in enumerate(pats):
            if t is not None:
                acc = acc + F.when(F.coalesce(t, F.lit("")) != "",
                                   F.lit(w_title * w) * _hits(t, pat)).otherwise(F.lit(0.0))
            body_hits = (_hits_filtered(b, bf, pat, anchors[ci][pi]) if anchors is not None
                         else _hits(b, pat))
            acc = acc + F.lit(w_body * w) * body_hits
        cols.append(acc.alias(score_column_name(name)))
    return cols


def _ranked(score_cols: list[str], names: list[str]) -> Column:
    """Array of (score, -declared rank, name) structs, best first."""
    items = [F.struct(F.col(c).alias("score"), F.lit(-i).alias("neg_rank"),
                      F.lit(n).alias("name"))
             for i, (c, n) in enumerate(zip(score_cols, names))]
    return F.sort_array(F.array(*items), asc=False)


def category_label(score_cols: list[str] | None = None, names: list[str] | None = None,
                   min_score: float = MIN_SCORE) -> Column:
    """Best category, or ``General`` when the best score is below ``min_score``."""
    names = CATEGORIES if names is None else names
    score_cols = [score_column_name(n) for n in names] if score_cols is None else score_cols
    best = F.greatest(*[F.col(c) for c in score_cols])
    pick = None
    # first declared category reaching the maximum wins the tie
    for c, n in reversed(list(zip(score_cols, names))):
        pick = F.when(F.col(c) == best, F.lit(n)) if pick is None else \
            F.when(F.col(c) == best, F.lit(n)).otherwise(pick)
    return F.when(best < min_score, F.lit(FALLBACK)).otherwise(pick)


def category_topk(k: int, score_cols: list[str] | None = None,
                  names: list[str] | None = None, min_score: float = MIN_SCORE) -> Column:
    """Top-k category names (zero scores may appear); ``['General']`` when the
    best score is below ``min_score``.  Always ``array<string>``."""
    names = CATEGORIES if names is None else names
    score_cols = [score_column_name(n) for n in names] if score_cols is None else score_cols
    ranked = _ranked(score_cols, names)
    top = F.transform(F.slice(ranked, 1, k), lambda x: x["name"])
    best = F.greatest(*[F.col(c) for c in score_cols])
    return F.when(best < min_score, F.array(F.lit(FALLBACK))).otherwise(top)


def score_frame(df, body: str, title: str | None = None, keep=None):
    """``df`` plus the 13 score columns, with the anchor prefilter: the
    folded body is computed once in its own projection, then every body
    regex is gated by cheap substring tests on it."""
    keep = df.columns if keep is None else keep
    f = df.select(*keep, *([] if body in keep else [body]), *([] if title is None or title in keep else [title]),
                  folded(F.coalesce(F.col(body), F.lit(""))).alias("_tm_fold"))
    return f.select(*keep, *category_score_columns(body, title, fold_col="_tm_fold"))


def with_categories(df, body: str, title: str | None = None, out: str = "system_category",
                    keep_scores: bool = False, rules=None):
    """Add the category label (and optionally the 13 score columns)."""
    rules = CATEGORY_RULES if rules is None else rules
    names = [n for n, _ in rules]
    score_names = [score_column_name(n) for n in names]
    if rules is CATEGORY_RULES:
        scored = score_frame(df, body, title)
    else:
        scored = df.select("*", *category_score_columns(body, title, rules))
    labelled = scored.withColumn(out, category_label(score_names, names))
    return labelled if keep_scores else labelled.drop(*score_names)
