"""Candidate profiles (P3) and posting match scores.

A profile is a handful of catalog names and a number, so it travels as
literal expressions inside the plan: scoring is a narrow projection over the
postings (no join, no shuffle) and Catalyst folds the profile constants.
Several profiles fan each posting out to one row per profile through a
``explode`` of a literal array; the number of profiles is checked because the
literals live in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..catalogs import KEYWORD_CATALOG, TECHNOLOGY_CATALOG, Catalog
from ..functions import scoring
from ..functions.memo import per_context
from ..functions.terms import extract_terms, required_years
from ..session import staged

MAX_LITERAL_PROFILES = 256


@dataclass(frozen=True)
class Profile:
    """What a CV says, in catalog terms."""

    technologies: frozenset[str]
    keywords: frozenset[str] = field(default_factory=frozenset)
    years_experience: float = 0.0
    profile_id: str = "cv"

    def __post_init__(self) -> None:
        object.__setattr__(self, "technologies", frozenset(self.technologies))
        object.__setattr__(self, "keywords", frozenset(self.keywords))
        object.__setattr__(self, "years_experience", float(self.years_experience))

    def as_struct(self) -> Column:
        return F.struct(
            F.lit(self.profile_id).alias("profile_id"),
            F.array(*[F.lit(t) for t in sorted(self.technologies)]).cast("array<string>").alias("technologies"),
            F.array(*[F.lit(k) for k in sorted(self.keywords)]).cast("array<string>").alias("keywords"),
            F.lit(self.years_experience).alias("years_experience"),
        )


def profile_columns(
    cv_text: Column,
    technologies: Catalog = TECHNOLOGY_CATALOG,
    keywords: Catalog = KEYWORD_CATALOG,
) -> tuple[Column, Column]:
    """(technologies, keywords) extracted from CV text with the posting catalogs."""
    return extract_terms(cv_text, technologies), extract_terms(cv_text, keywords)


def profiles_from_text(
    cvs: DataFrame,
    id_col: str = "profile_id",
    text_col: str = "cv_text",
    years_col: str = "years_experience",
) -> DataFrame:
    """``(profile_id, cv_text, years_experience)`` rows -> profiles.

    A narrow projection; runs where the CV rows are.
    """
    techs, kws = profile_columns(F.col(text_col))
    return cvs.select(
        F.col(id_col).cast("string").alias("profile_id"),
        techs.alias("technologies"),
        kws.alias("keywords"),
        F.col(years_col).cast("double").alias("years_experience"),
    )


def build_profile(spark: SparkSession, cv_text: str, years_experience: float, profile_id: str = "cv") -> Profile:
    """One profile from one CV text.

    Uses the same Spark expressions as the postings side, so both sides speak
    the same vocabulary; the input is one literal row, folded by the optimiser.
    """
    techs, kws = profile_columns(F.lit(cv_text))
    row = spark.range(1).select(techs.alias("t"), kws.alias("k")).first()
    return Profile(frozenset(row["t"]), frozenset(row["k"]), years_experience, profile_id)


def profiles_from_frame(profiles: DataFrame, limit: int = MAX_LITERAL_PROFILES) -> list[Profile]:
    """Profiles held in a DataFrame (as produced by :func:`profiles_from_text`)
    as literal :class:`Profile` values for :func:`match_scores`.

    At most ``limit + 1`` rows are read, so an unexpectedly large table fails
    fast instead of flooding the driver; score larger candidate sets with
    :func:`match_profile_table`.
    """
    rows = profiles.select("profile_id", "technologies", "keywords", "years_experience").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} profiles; score them in slices")
    return [
        Profile(frozenset(r["technologies"] or ()), frozenset(r["keywords"] or ()), r["years_experience"] or 0.0, r["profile_id"])
        for r in rows
    ]


MATCH_COLUMNS = [
    "job_id",
    "company",
    "title",
    "location",
    "remote",
    "link",
    "match_score",
    "matched_skills",
    "missing_skills",
    "matched_keywords",
    "required_years",
    "rationale",
]


@per_context
def _match_stages(plist: tuple, single: bool) -> list[list]:
    """Projections of :func:`match_scores` (built once per session)."""
    # Posting-side features are computed once per posting, before any fan-out.
    # Only keywords some profile has can ever match, so only those are searched.
    wanted = set().union(*(p.keywords for p in plist))
    kw_catalog = {k: v for k, v in KEYWORD_CATALOG.items() if k in wanted}
    feats = [
        *MATCH_COLUMNS[:6],
        scoring.required_set(F.col("technologies")).alias("_req"),
        required_years(F.col("description")).alias("_req_years"),
        extract_terms(F.col("description"), kw_catalog).alias("_post_kws"),
    ]
    if len(plist) == 1:
        p = plist[0].as_struct()
        keys: list = [] if single else [p["profile_id"].alias("profile_id")]
        return [feats, *_score_stages(p, keys)]
    fan = ["*", F.explode(F.array(*[pr.as_struct() for pr in plist])).alias("_p")]
    return [feats, fan, *_score_stages(F.col("_p"), [F.col("_p.profile_id").alias("profile_id")])]


def _score_stages(p: Column, keys: list) -> list[list]:
    """Score in projections so that every set is computed once (Catalyst keeps
    non-cheap projections apart instead of inlining them); the last one adds
    the explanation."""
    sets = [
        *keys,
        *MATCH_COLUMNS[:6],
        F.col("_req_years").alias("required_years"),
        *[c.alias(n) for c, n in zip(scoring.skill_sets(F.col("_req"), p["technologies"]), ["matched_skills", "missing_skills"])],
        scoring.keyword_bonus(p["keywords"], F.col("_post_kws"))[0].alias("matched_keywords"),
        p["years_experience"].alias("_cv_years"),
    ]
    parts = [
        "*",
        scoring.skill_ratio(F.col("matched_skills"), F.col("missing_skills")).alias("_ratio"),
        *[c.alias(n) for c, n in zip(scoring.years_fit(F.col("required_years"), F.col("_cv_years")), ["_ys", "_gap"])],
        scoring.bonus_points(F.col("matched_keywords")).alias("_bonus"),
    ]
    score = ["*", scoring.final_score(F.col("_ratio"), F.col("_ys"), F.col("_bonus")).alias("match_score")]
    out_keys = ["profile_id"] if keys else []
    final = [
        *out_keys,
        *MATCH_COLUMNS[:6],
        "match_score",
        "matched_skills",
        "missing_skills",
        "matched_keywords",
        "required_years",
        scoring.rationale(
            F.col("_ratio"), F.col("matched_skills"), F.col("missing_skills"),
            F.col("required_years"), F.col("_gap"), F.col("matched_keywords"),
        ).alias("rationale"),
    ]
    return [sets, parts, score, final]


def match_scores(
    postings: DataFrame,
    profiles: Profile | Sequence[Profile],
    ordered: bool = False,
    top_k: int | None = None,
) -> DataFrame:
    """Score every Silver posting against one or more profiles.

    ``postings`` needs ``job_id, company, title, location, remote, link,
    technologies, description``.  One profile gives the upstream columns;
    several add a leading ``profile_id``.  ``ordered`` sorts by score
    (descending) then ``job_id`` - a global sort, which scores every row once
    more to find its ranges, so it is off by default; ``top_k`` keeps the best ``k`` postings per
    profile (a per-profile ``row_number`` that Spark turns into a
    WindowGroupLimit before the shuffle).
    """
    single = isinstance(profiles, Profile)
    plist = [profiles] if single else list(profiles)
    if not plist:
        raise ValueError("at least one profile is required")
    if len(plist) > MAX_LITERAL_PROFILES:
        raise ValueError(
            f"{len(plist)} profiles exceed {MAX_LITERAL_PROFILES}; score them in several calls"
        )
    if len({p.profile_id for p in plist}) != len(plist):
        raise ValueError("profile ids must be unique")

    scored = postings
    *stages, explained = _match_stages(tuple(plist), single)
    for stage in stages:
        scored = scored.select(*stage)
    keys = [] if single else ["profile_id"]
    if top_k is not None and keys:  # only the best are explained
        w = Window.partitionBy(*keys).orderBy(F.col("match_score").desc(), F.col("job_id"))
        scored = scored.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= top_k)
    scored = scored.select(*explained)
    if top_k is not None and not keys:
        # per-partition top-k, then one merge of k rows per partition
        return scored.orderBy(F.col("match_score").desc(), F.col("job_id")).limit(top_k)
    if ordered:
        scored = scored.orderBy(*keys, F.col("match_score").desc(), F.col("job_id"))
    return scored


# Technology sets of postings per task of the grid of profile blocks and posting chunks.
CHUNK_KINDS = 4096

# Key of postings without required years (those of a text are never negative).
NO_YEARS = -1.0


def _terms(c: str) -> Column:
    """A set column in one spelling: no nulls, no repeats, sorted."""
    given = F.coalesce(F.col(c), F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.filter(given, lambda x: x.isNotNull())))


def _digest(*columns: str) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))


def profile_kinds(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile_id, _sig) of every profile row, and the distinct profiles
    (_sig, _p) they stand for: a score depends on terms and years alone."""
    keyed = profiles.select(
        F.col("profile_id").cast("string").alias("profile_id"),
        _terms("technologies").alias("technologies"),
        _terms("keywords").alias("keywords"),
        F.coalesce(F.col("years_experience").cast("double"), F.lit(0.0)).alias("years_experience"),
    ).withColumn("_sig", _digest("technologies", "keywords", "years_experience"))
    keyed = staged(keyed)  # read twice: the terms of a text are looked up once
    kinds = keyed.groupBy("_sig").agg(F.any_value(F.struct("technologies", "keywords", "years_experience")).alias("_p"))
    return keyed.select("profile_id", "_sig"), kinds


def posting_kinds(postings: DataFrame, top_k: int) -> DataFrame:
    """Postings that score alike, as one row: (_post, _req, _req_years,
    _post_kws, _first, _postings), with the ``top_k`` of smallest ``job_id``.
    The limit is applied before the shuffle, so common kinds are no hot keys."""
    feats = postings.select(
        *MATCH_COLUMNS[:6],
        F.array_sort(scoring.required_set(F.col("technologies"))).alias("_req"),
        required_years(F.col("description")).alias("_req_years"),
        F.array_sort(extract_terms(F.col("description"), KEYWORD_CATALOG)).alias("_post_kws"),
    ).withColumn("_post", _digest("_req", "_req_years", "_post_kws"))
    place = Window.partitionBy("_post").orderBy("job_id")
    return (
        feats.withColumn("_n", F.row_number().over(place))
        .filter(F.col("_n") <= top_k)
        .groupBy("_post")
        .agg(
            *[F.any_value(c).alias(c) for c in ("_req", "_req_years", "_post_kws")],
            F.min(F.when(F.col("_n") == 1, F.struct("job_id"))).alias("_first"),
            F.collect_list(F.struct(*MATCH_COLUMNS[:6])).alias("_postings"),
        )
    )


def _ratios(kinds: DataFrame, posts: DataFrame, block: int, chunk: int) -> DataFrame:
    """(_t, _r, _ratio) of every pair of technology sets, of profiles and of
    postings, as a grid of blocks and chunks."""
    techs = kinds.groupBy("_t").agg(F.any_value("_p.technologies").alias("_techs"))
    reqs = posts.groupBy("_r").agg(F.any_value("_req").alias("_req"))
    blocks, chunks = (max(1, -(-df.count() // size)) for df, size in ((techs, block), (reqs, chunk)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = (
        techs.groupBy(place("_t", blocks).alias("_block"))
        .agg(F.collect_list(F.struct("_t", "_techs")).alias("_sets"))
        .withColumn("_chunk", each(chunks))
    )
    right = reqs.select("_r", "_req", place("_r", chunks).alias("_chunk"), each(blocks).alias("_block"))
    pairs = right.join(left, ["_block", "_chunk"]).select("_r", "_req", F.explode("_sets").alias("_x"))
    sets = scoring.skill_sets(F.col("_req"), F.col("_x._techs"))
    return pairs.select(
        F.col("_x._t").alias("_t"), "_r", *[c.alias(n) for c, n in zip(sets, ["_matched", "_missing"])]
    ).select("_t", "_r", scoring.skill_ratio(F.col("_matched"), F.col("_missing")).alias("_ratio"))


def _places(kinds: DataFrame, posts: DataFrame, ratios: DataFrame, top_k: int) -> DataFrame:
    """(_sig, _t, _keywords, _ratio, _y, _ys): for every profile kind the skill
    ratios and required years at which one of its best ``top_k`` postings may be.

    Without keywords ``top_k`` postings score ``_floor`` or more, so a posting
    that cannot reach it with all its keywords in common is not among the best.
    """
    groups = posts.groupBy("_r", "_y").agg(F.sum(F.size("_postings")).alias("_n"), F.max(F.size("_post_kws")).alias("_kws"))
    cells = ratios.join(groups, "_r").groupBy("_t", "_ratio", "_y").agg(F.sum("_n").alias("_n"), F.max("_kws").alias("_kws"))
    fit = scoring.years_fit(F.nullif(F.col("_y"), F.lit(NO_YEARS)), F.col("_p.years_experience"))[0]
    met = kinds.join(cells, "_t").select(
        "_sig", "_t", F.col("_p.keywords").alias("_keywords"), "_ratio", "_y", "_n", "_kws", fit.alias("_ys")
    )
    most = scoring.points(F.least(F.size("_keywords"), F.col("_kws")))
    bounds = met.select(
        "*",
        scoring.final_score(F.col("_ratio"), F.col("_ys"), F.lit(0)).alias("_low"),
        scoring.final_score(F.col("_ratio"), F.col("_ys"), most).alias("_high"),
    )
    kind = Window.partitionBy("_sig")
    reached = bounds.withColumn("_sum", F.sum("_n").over(kind.orderBy(F.col("_low").desc())))
    floor = F.coalesce(F.max(F.when(F.col("_sum") >= top_k, F.col("_low"))).over(kind), F.lit(0))
    return reached.withColumn("_floor", floor).filter("_high >= _floor").select("_sig", "_t", "_keywords", "_ratio", "_y", "_ys")


def near_pairs(kinds: DataFrame, posts: DataFrame, top_k: int, block: int = MAX_LITERAL_PROFILES, chunk: int = CHUNK_KINDS) -> DataFrame:
    """(_sig, _keywords, _post, _post_kws, _first, _ratio, _ys): the pairs of a
    profile kind and a posting kind that may be among its best ``top_k``."""
    kinds = kinds.withColumn("_t", _digest("_p.technologies"))
    posts = posts.withColumn("_r", _digest("_req")).withColumn("_y", F.coalesce("_req_years", F.lit(NO_YEARS)))
    ratios = _ratios(kinds, posts, block, chunk)
    places = _places(kinds, posts, ratios, top_k)
    found = posts.select("_post", "_r", "_y", "_post_kws", "_first")
    return places.join(ratios, ["_t", "_ratio"]).join(found, ["_r", "_y"]).drop("_t", "_r", "_y")


def match_profile_table(
    postings: DataFrame, profiles: DataFrame, top_k: int, block: int = MAX_LITERAL_PROFILES, chunk: int = CHUNK_KINDS
) -> DataFrame:
    """P4 for a table of profiles of any length: the best ``top_k`` postings of
    each, with their ``rank`` (score descending, then ``job_id``).

    Both sides are reduced to what a score depends on: profiles to distinct
    (technologies, keywords, years), postings to distinct features with their
    first ``top_k`` rows.  Different technology sets of profiles, in blocks, meet
    those of postings, in chunks, one bounded pair per key, for their skill ratio.
    Ratio and required years bound a score on both sides: a profile kind meets
    only the posting kinds whose best possible score is not under that of
    ``top_k`` postings without any keyword in common, and these are scored by the
    same column expressions as :func:`match_scores`; each task keeps ``top_k``
    kinds per profile before anything is shuffled.  Only the numbers of sets reach
    the driver, and the plan does not grow with either table.

    Every row of ``profiles`` is a profile: a null id keeps its matches under a
    null ``profile_id``, rows that repeat an id each get their own.  Null sets
    are empty and null years are 0.  An empty table on either side gives an
    empty result.
    """
    keyed, kinds = profile_kinds(profiles)
    kinds, posts = staged(kinds), staged(posting_kinds(postings, top_k))
    pairs = near_pairs(kinds, posts, top_k, block, chunk)
    bonus = scoring.keyword_bonus(F.col("_keywords"), F.col("_post_kws"))[1]
    scored = pairs.select("_sig", "_post", "_first", scoring.final_score(F.col("_ratio"), F.col("_ys"), bonus).alias("_score"))
    # A posting among the best k belongs to one of the best k kinds, by score
    # and first posting: every kind before it has a posting before it.
    best = Window.partitionBy("_sig").orderBy(F.col("_score").desc(), "_first")
    near = scored.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= top_k).select("_sig", "_post", "_score")
    listed = near.join(posts, "_post").select("_sig", "_score", "_req", "_req_years", "_post_kws", F.explode("_postings").alias("_j"))
    order = Window.partitionBy("_sig").orderBy(F.col("_score").desc(), "_j.job_id")
    winners = (
        listed.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top_k)
        .join(kinds, "_sig")
        .select("_sig", "rank", "_p", "_req", "_req_years", "_post_kws", *[F.col(f"_j.{c}").alias(c) for c in MATCH_COLUMNS[:6]])
    )
    *stages, final = _score_stages(F.col("_p"), [F.col("_sig").alias("profile_id"), "rank"])
    for stage in stages:
        winners = winners.select(*stage)
    found = winners.select(*final, "rank").withColumnRenamed("profile_id", "_sig")
    return keyed.join(found, "_sig").select("profile_id", *MATCH_COLUMNS, "rank")
