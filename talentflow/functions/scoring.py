"""Match-score pieces (F12-F16): skill coverage, years fit, keyword bonus,
final score and the explanation text.  All inputs are Columns so the same code
serves literal profiles and profile columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: weights and bonus of the score formula. -----------------
SKILL_WEIGHT = 0.7
YEARS_WEIGHT = 0.3
KEYWORD_BONUS_PER_MATCH = 2
MAX_KEYWORD_BONUS = 10
NEUTRAL_SKILL_RATIO = 0.5
NEUTRAL_YEARS_SCORE = 1.0

# --- Fixed values: explanation sentences (Italian, as produced upstream). ---
TXT_COVERAGE = "Copertura tecnologica: {m}/{n} skill richieste presenti nel CV ({pct}%)."
TXT_NO_TECH = "Nessuna tecnologia esplicita richiesta dall'offerta."
TXT_YEARS_OK = "Esperienza richiesta: {y} anni, soddisfatta (margine di +{gap})."
TXT_YEARS_GAP = "Esperienza richiesta: {y} anni, gap di {gap} anni rispetto al profilo."
TXT_NO_YEARS = "Nessun requisito esplicito di anni di esperienza rilevato."
TXT_KEYWORDS = "Parole chiave in comune: {kw}."

def _empty() -> Column:
    return F.array().cast("array<string>")


def required_set(required: Column) -> Column:
    """The posting's technologies as a set; NULL counts as empty."""
    return F.array_distinct(F.coalesce(required, _empty()))


def skill_sets(req: Column, cv: Column) -> tuple[Column, Column]:
    """F12 (sets): matched and missing skills, sorted by code point, for a
    requirement set ``req`` (see :func:`required_set`)."""
    cvs = F.coalesce(cv, _empty())
    matched = F.sort_array(F.array_intersect(req, cvs))
    missing = F.sort_array(F.array_except(req, cvs))
    return matched, missing


def skill_ratio(matched: Column, missing: Column) -> Column:
    """F12 (ratio): |matched| / |required|; an empty requirement is neutral."""
    n = F.size(matched) + F.size(missing)
    return F.when(n == 0, F.lit(NEUTRAL_SKILL_RATIO)).otherwise(F.size(matched) / n)


def years_fit(required_years: Column, candidate_years: Column) -> tuple[Column, Column]:
    """(years_score, gap).  Unknown requirement -> (1.0, NULL).

    An infinite requirement scores 0.  (Spark orders NaN above every number,
    so it is tested for before any comparison.)
    """
    gap = candidate_years.cast("double") - required_years
    share = F.lit(1.0) + gap / F.greatest(required_years, F.lit(1.0))
    score = (
        F.when(required_years.isNull(), F.lit(NEUTRAL_YEARS_SCORE))
        .when(gap_met(gap), F.lit(1.0))
        .when(F.isnan(share), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), share))
    )
    return score, gap


def gap_met(gap: Column) -> Column:
    return (gap >= 0) & ~F.isnan(gap)


def keyword_bonus(cv_keywords: Column, posting_keywords: Column) -> tuple[Column, Column]:
    """(matched keywords sorted, bonus points capped)."""
    matched = F.sort_array(F.array_intersect(F.coalesce(cv_keywords, _empty()), F.coalesce(posting_keywords, _empty())))
    return matched, bonus_points(matched)


def bonus_points(matched_keywords: Column) -> Column:
    return points(F.size(matched_keywords))


def points(n_keywords: Column) -> Column:
    return F.least(n_keywords * KEYWORD_BONUS_PER_MATCH, F.lit(MAX_KEYWORD_BONUS))


def final_score(ratio: Column, years_score: Column, bonus: Column) -> Column:
    """clamp(round_half_even((ratio*0.7 + years*0.3)*100 + bonus), 0, 100)."""
    base = (ratio * F.lit(SKILL_WEIGHT) + years_score * F.lit(YEARS_WEIGHT)) * F.lit(100.0)
    rounded = F.rint(base + bonus.cast("double"))
    return F.greatest(F.lit(0), F.least(F.lit(100), rounded.cast("int")))


def _int_text(x: Column) -> Column:
    """A double rounded half-even and printed without decimals, whatever its
    size: ``inf`` and ``nan`` by name; from 2**63 on, digits past the 17th may
    differ from the exact binary value."""
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(F.abs(x) == F.lit(float("inf")), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(F.abs(x) < F.lit(2.0**63), F.rint(x).cast("bigint").cast("string"))
        .otherwise(F.format_string("%.0f", x))
    )


def _fill(template: str, **parts: Column) -> Column:
    """Assemble a template like 'a {x} b' from literal pieces and columns."""
    pieces: list[Column] = []
    rest = template
    while rest:
        start = rest.find("{")
        if start < 0:
            pieces.append(F.lit(rest))
            break
        end = rest.index("}", start)
        if start:
            pieces.append(F.lit(rest[:start]))
        pieces.append(parts[rest[start + 1 : end]])
        rest = rest[end + 1 :]
    return F.concat(*pieces)


def rationale(
    ratio: Column,
    matched: Column,
    missing: Column,
    required_years: Column,
    gap: Column,
    matched_keywords: Column,
) -> Column:
    """F16: two or three sentences joined by one space."""
    m = F.size(matched)
    n = m + F.size(missing)
    coverage = F.when(
        n > 0,
        _fill(TXT_COVERAGE, m=m.cast("string"), n=n.cast("string"), pct=_int_text(ratio * F.lit(100.0))),
    ).otherwise(F.lit(TXT_NO_TECH))
    years = (
        F.when(required_years.isNull(), F.lit(TXT_NO_YEARS))
        .when(gap_met(gap), _fill(TXT_YEARS_OK, y=_int_text(required_years), gap=_int_text(gap)))
        .otherwise(_fill(TXT_YEARS_GAP, y=_int_text(required_years), gap=_int_text(F.abs(gap))))
    )
    kw = F.when(F.size(matched_keywords) > 0, _fill(TXT_KEYWORDS, kw=F.array_join(matched_keywords, ", ")))
    return F.concat_ws(" ", coverage, years, kw)
