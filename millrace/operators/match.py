"""Entity matching: fuzzy join of names on weighted tokens, exact top-k, supervised scoring."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.lineage import materialize

# Feature types of a matching model.
FEATURE_TYPES = (
    "simple", "insensitive", "bigram", "frequencyweightedbigram", "bigramextratokenizers", "bigramcombo",
)
_TOKEN = r"(\p{L}+|\p{N}+)"


def name_features(name: Column, feature_type: str = "simple") -> Column:
    """Feature texts of a name: runs of letters or digits, and pairs of adjacent runs.

    simple keeps case; insensitive and the bigram types fold it. The extra tokenizers
    also split camel case and drop leading zeros.
    """
    if feature_type not in FEATURE_TYPES:
        raise ValueError(f"feature type must be one of {FEATURE_TYPES}")
    extra = feature_type in ("bigramextratokenizers", "bigramcombo")
    text = F.coalesce(name, F.lit(""))
    if extra:
        text = F.regexp_replace(text, r"(\p{Ll})(\p{Lu})", "$1 $2")
    if feature_type != "simple":
        text = F.lower(text)
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(1))
    if extra:
        tokens = F.transform(tokens, lambda t: F.regexp_replace(t, r"^0+(?=\p{N})", ""))
    if feature_type in ("simple", "insensitive"):
        return tokens
    starts = F.when(F.size(tokens) > 1, F.sequence(F.lit(1), F.size(tokens) - 1)) \
        .otherwise(F.array().cast("array<int>"))
    pairs = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(2)), "\u0001"))
    return F.concat(tokens, pairs)


def _texts(df: DataFrame, fields: Sequence[str], feature_type: str, ignore_missing: bool) -> DataFrame:
    """Rows plus ``_features``; with ``ignore_missing`` absent fields count as empty."""
    parts = [name_features(F.col(f).cast("string"), feature_type) for f in fields]
    usable = F.lit(True)
    if not ignore_missing:
        for f in fields:
            usable = usable & F.col(f).isNotNull()
    return df.where(usable).withColumn("_features", F.array_sort(F.concat(*parts)))


# So many of the most frequent tokens at most reach all tasks as a table.
_FREQUENT = 10_000


def _vectors(names: DataFrame, weights: DataFrame) -> DataFrame:
    """Numbered feature lists to unit vectors ``_vec array<struct<df, token, w, n, rest>>`` and ``_norm``.

    Rare tokens come first; ``n`` counts the token, ``rest`` is the norm of the tokens after it. Lists move once,
    by their number; of their tokens only the less frequent ones move to meet their weight.
    """
    # A token that every other name holds makes up most rows and would meet its weight in one task.
    frequent = materialize(weights.orderBy(F.desc("df"), "token").limit(_FREQUENT), "match")
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = F.transform(F.array_distinct("_features"), lambda t: F.struct(
        t.alias("token"), F.size(F.filter("_features", lambda f: f == t)).alias("n")))
    told = lambda df: df.select("_id", F.explode(counted).alias("e")).select("_id", "e.token", "e.n")
    packed = lambda df, name: df.groupBy("_id").agg(F.collect_list(F.struct(
        "df", "token", (F.col("n") * F.col("idf")).alias("w"), "n")).alias(name))
    often = packed(told(names.select("_id", "_features").repartition(tasks, "_id")).join(F.broadcast(frequent), "token"), "_often")
    others = told(names).join(F.broadcast(frequent.select("token")), "token", "left_anti")
    seldom = packed(others.join(weights.join(F.broadcast(frequent.select("token")), "token", "left_anti"), "token"), "_seldom")
    vec = F.array_sort(F.concat(*(F.coalesce(name, F.array().cast(often.schema["_often"].dataType)) for name in ("_often", "_seldom"))))
    mass = lambda v: F.aggregate(v, F.lit(0.0), lambda s, e: s + e["w"] * e["w"])
    raw = often.join(seldom, "_id", "full").select("_id", vec.alias("_vec")).withColumn("_norm", F.sqrt(mass(F.col("_vec"))))
    unit = raw.select("_id", "_norm", F.transform("_vec", lambda e: e.withField("w", e["w"] / F.col("_norm"))).alias("_vec"))
    rest = lambda i: F.sqrt(mass(F.slice("_vec", i + 2, F.greatest(F.size("_vec") - i - 1, F.lit(0)))))
    return unit.select("_id", "_norm", F.transform("_vec", lambda e, i: e.withField("rest", rest(i))).alias("_vec"))


def _prefix(vec: Column, threshold: float) -> Column:
    """Entries that a partner scoring at least ``threshold`` must share one of.

    Walking from the frequent end, tokens are left out while their joint weight stays
    below the threshold: a partner sharing only those cannot reach it.
    """
    if threshold <= 0:
        return vec
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("n"))
    # The small slack keeps rounding from dropping a pair that sits on the threshold.
    limit = max(threshold * threshold - 1e-9, 0.0)
    droppable = F.aggregate(
        F.reverse(vec), start,
        lambda s, e: F.struct(
            (s["mass"] + e["w"] * e["w"]).alias("mass"),
            (s["n"] + F.when(s["mass"] + e["w"] * e["w"] < limit, 1).otherwise(0)).alias("n"),
        ),
    )["n"]
    return F.slice(vec, F.lit(1), F.greatest(F.size(vec) - droppable, F.lit(0)))


def _weight_map(vec: Column) -> Column:
    return F.map_from_arrays(F.transform(vec, lambda e: e["token"]), F.transform(vec, lambda e: e["w"]))


def _dot(vec: str, weight_map: str) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, e: acc + e["w"] * F.coalesce(
        F.try_element_at(weight_map, e["token"]), F.lit(0.0)))


def _reaches(threshold: float) -> Column:
    # The slack keeps a pair that sits on the threshold whatever the rounding.
    return (F.col("score") >= F.lit(threshold - 1e-9)) & (F.col("score") > 0)


def _scored_pairs(sources: DataFrame, targets: DataFrame, threshold: float, limit: int | None = None) -> DataFrame:
    """All vector pairs scoring at least ``threshold`` (above 0): ``(_sf, _tf, score)``.

    With ``limit`` only pairs that share a token of at most that many names.

    A pair is produced only at the first prefix token it shares, so no distinct is
    needed. There its score is at most that token's share plus the product of the
    remaining norms, which drops most pairs inside the join.
    """
    prefix = _prefix(F.col("_vec"), threshold)
    if limit is not None:
        prefix = F.filter(prefix, lambda e: e["df"] <= limit)
    tokens = F.transform(prefix, lambda e: e["token"])
    # Few source bytes can mean many pairs, so the split goes by token, or by row where tokens may be frequent, not by size.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = "token" if limit is not None and limit <= _COMMON_DF else "_sf"
    # Of the vectors only what scores moves.
    weighed = F.transform("_vec", lambda e: F.struct(e["token"].alias("token"), e["w"].alias("w")))
    entry = lambda end: [F.col("_e.w").alias(f"_{end}w"), F.col("_e.rest").alias(f"_{end}rest"), F.col("_e.token").alias("token")]
    s = sources.select(
        F.col("_features").alias("_sf"), weighed.alias("_sv"), tokens.alias("_sp"), F.explode(prefix).alias("_e"),
    ).select("_sf", "_sv", "_sp", *entry("s")).repartition(tasks, split)
    t = targets.select(
        # The map is built once per target, below the join.
        F.col("_features").alias("_tf"), tokens.alias("_tp"), _weight_map(F.col("_vec")).alias("_tw"), F.explode(prefix).alias("_e"),
    ).select("_tf", "_tp", "_tw", *entry("t_"))
    bound = F.col("_sw") * F.col("_t_w") + F.col("_srest") * F.col("_t_rest")
    pairs = s.join(t, "token").where(bound >= F.lit(threshold - 1e-9))
    first = F.get(F.array_intersect("_sp", "_tp"), F.lit(0)) == F.col("token")
    return pairs.where(first).select("_sf", "_tf", _dot("_sv", "_tw").alias("score")).where(_reaches(threshold))


# Tokens of more names than this are common. At most so many names may hold more common tokens than so
# many: beyond, the limit rises.
_COMMON_DF, _COMMON_PER_NAME, _LONG_NAMES = 128, 8, 1024


def _common_limit(vectors: DataFrame) -> tuple[int, bool]:
    """The number of names above which a token is common, and whether any token is."""
    df_from_top = lambda i: F.get("_vec", F.size("_vec") - 1 - i)["df"]
    beyond = vectors.select(df_from_top(_COMMON_PER_NAME).alias("df")).where(F.col("df") > _COMMON_DF)
    long_names = beyond.orderBy(F.desc("df")).limit(_LONG_NAMES + 1).collect()
    limit = long_names[-1]["df"] if len(long_names) > _LONG_NAMES else _COMMON_DF
    most = vectors.agg(F.max(df_from_top(0))).first()[0]
    return limit, (most or 0) > limit


def _subsets(entries: Column) -> Column:
    """Texts of all non-empty choices of entries, each entry ``array<string>`` offering variants."""
    start = F.array(F.lit(""))
    grown = F.aggregate(entries, start, lambda acc, e: F.flatten(F.transform(
        acc, lambda a: F.concat(F.array(a), F.transform(e, lambda v: F.concat(a, F.lit("\u0002"), v))))))
    return F.filter(grown, lambda a: a != "")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a number per row."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "match")


def _common_pairs(sources: DataFrame, targets: DataFrame, copies: DataFrame, limit: int, k: int, threshold: float) -> DataFrame:
    """``(_sf, target_id, score)``: the ``k`` best of each source by its common tokens alone.

    Names that hold the same common tokens at the same weight score alike, so sources and targets
    meet as classes, and copies of a class cost nothing. Of targets that hold one set of common tokens
    equally often the ``k`` of least norm are enough, of names as of targets. A source does not know which of its tokens a target
    holds, so it looks up all choices of them; classes of too many common tokens for that are met
    token by token. A pair that shares a rare token as well scores less here than by all its tokens.
    ``copies`` is ``(_tf, target_id)`` with the lowest ids of each target name.
    """
    variant = lambda token, n: F.concat(token, F.lit("\u0003"), n.cast("string"))
    fields = ("df", "token", "w", "n")
    common = F.transform(F.filter("_vec", lambda e: e["df"] > limit), lambda e: F.struct(*(e[f].alias(f) for f in fields)))
    holding = lambda df: df.withColumn("_common", common).where(F.size("_common") > 0)
    of_set = W.partitionBy("_set").orderBy(F.round("_norm", 12), "target_id")
    shortest = lambda df: df.withColumn("_n", F.row_number().over(of_set)).where(F.col("_n") <= k).drop("_n")
    sets = holding(targets).select(F.col("_features").alias("_tf"), F.col("_lowest").alias("target_id"), "_norm", "_common", F.transform(
        "_common", lambda e: variant(e["token"], e["n"])).alias("_set"))
    # Each name has its lowest id to offer, so names beyond the k-th have none that counts.
    kept = _numbered(shortest(shortest(sets).drop("target_id").join(copies, "_tf").drop("_tf")), "_kept")
    members = holding(sources).select(F.col("_features").alias("_sf"), "_common")
    classes = _numbered(members.select("_common").distinct(), "_class")

    short = F.size("_common") <= _COMMON_PER_NAME
    of_key = W.partitionBy("key").orderBy(F.round("_norm", 12), "target_id")
    own = F.transform("_set", lambda v: F.array(v))
    offered = kept.where(short).select("_kept", "_norm", "target_id", F.explode(_subsets(own)).alias("key")) \
        .withColumn("_n", F.row_number().over(of_key)).where(F.col("_n") <= k).select("key", "_kept")
    # A source does not know how often a target holds a token: it tries every count in use.
    counts = kept.select(F.explode("_common").alias("e")).groupBy(F.col("e.token").alias("token")).agg(
        F.sort_array(F.collect_set(variant(F.col("e.token"), F.col("e.n")))).alias("variants"))
    wanted = classes.where(short).select("_class", F.explode("_common").alias("e")).select(
        "_class", F.col("e.df").alias("df"), F.col("e.token").alias("token"))
    offers = wanted.join(counts, "token").groupBy("_class").agg(
        F.array_sort(F.collect_list(F.struct("df", "token", "variants"))).alias("_offers"))
    keys = offers.select("_class", F.explode(_subsets(F.transform("_offers", lambda o: o["variants"]))).alias("key"))
    pairs = keys.join(offered, "key").select("_class", "_kept")
    each = lambda df, number: df.select(number, short.alias(f"{number}_short"), F.explode("_common").alias("e")).select(
        number, f"{number}_short", F.col("e.token").alias("token"))
    by_token = each(classes, "_class").join(each(kept, "_kept"), "token").where(
        ~(F.col("_class_short") & F.col("_kept_short")))
    pairs = pairs.unionByName(by_token.select("_class", "_kept")).distinct()

    held = kept.select("_kept", "target_id", _weight_map(F.col("_common")).alias("_tw"))
    scored = pairs.join(classes, "_class").join(held, "_kept").select(
        "_class", "target_id", F.round(_dot("_common", "_tw"), 9).alias("score"))
    best = W.partitionBy("_class").orderBy(F.desc("score"), "target_id")
    ranked = scored.where(_reaches(threshold)).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    top = materialize(classes.join(ranked.drop("_n"), "_class").drop("_class"), "match")
    return members.join(top, "_common").select("_sf", "target_id", "score")


@dataclass(frozen=True)
class MatchModel:
    """An unsupervised model: which fields to compare and how."""

    source_fields: tuple[str, ...]
    target_fields: tuple[str, ...]
    feature_type: str = "simple"
    ignore_missing: bool = True

    def __post_init__(self):
        if self.feature_type not in FEATURE_TYPES:
            raise ValueError(f"feature type must be one of {FEATURE_TYPES}")
        if len(self.source_fields) != len(self.target_fields):
            raise ValueError("match fields come in source/target pairs")


# Scores are found band by band, best first; a source with enough matches leaves.
_BANDS = (0.8, 0.4)
# Pairs per name up to which bands save less than they read.
_FEW_PAIRS = 16


def _weights(names: DataFrame, feature_type: str) -> DataFrame:
    """``(token, df, idf)``; only the frequency-weighted types weigh rare tokens up."""
    df = names.select(F.explode(F.array_distinct("_features")).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("df")
    )
    if feature_type not in ("frequencyweightedbigram", "bigramcombo"):
        return df.withColumn("idf", F.lit(1.0))
    return df.withColumn("idf", F.log(F.lit(1.0) + F.lit(float(names.count())) / F.col("df")))


def _ranked():
    return W.partitionBy("_sf").orderBy(F.desc("score"), "target_id")


def _top(scored: DataFrame, copies: DataFrame, k: int) -> DataFrame:
    """Best ``k`` targets per source name; fixed precision makes ties independent of summation order."""
    return (
        scored.withColumn("score", F.round("score", 9)).join(copies, "_tf")
        .withColumn("rank", F.row_number().over(_ranked())).where(F.col("rank") <= k)
        .select("_sf", "target_id", "score", "rank")
    )


def _merged_top(found: DataFrame, more: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of two findings of ``(_sf, target_id, score)``; a pair in both counts with its larger score."""
    both = found.unionByName(more).repartition("_sf").groupBy("_sf", "target_id").agg(F.max("score").alias("score"))
    return both.withColumn("rank", F.row_number().over(_ranked())).where(F.col("rank") <= k)


def _by_band(open_sources: DataFrame, find, k: int, bands: Sequence[float]) -> DataFrame:
    """Run ``find(open sources, band) -> (top rows, certain score)`` down the bands.

    A source leaves once its k-th match reaches the certain score, above which the
    band is known to be complete; the last band settles the rest.
    """
    done = None
    for band in bands:
        best, certain = find(open_sources, band)
        best = materialize(best, "match")
        if band == bands[-1]:
            return best if done is None else done.unionByName(best)
        full = best.where((F.col("rank") == k) & (F.col("score") >= certain)).select("_sf")
        settled = best.join(full, "_sf", "left_semi")
        done = settled if done is None else done.unionByName(settled)
        open_sources = open_sources.join(full.withColumnRenamed("_sf", "_features"), "_features", "left_anti")
        if open_sources.isEmpty():
            return done
    return done


def _lowest_ids(rows: DataFrame, k: int) -> DataFrame:
    """Of targets under one name, the k lowest ids: no source can use more."""
    by_id = W.partitionBy("_features").orderBy("target_id")
    kept = rows.distinct().withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= k)
    return kept.select(F.col("_features").alias("_tf"), "target_id")


def match_pairs(sources: DataFrame, targets: DataFrame, model: MatchModel, num_matches: int = 1,
                score_threshold: float = 0.0, source_id: str = "id", target_id: str = "id") -> DataFrame:
    """``(source_id, target_id, score, rank)``: the best ``num_matches`` per source, ties by target id.

    Equal names are matched once: the work runs on distinct feature lists, so copies
    cost one row. Pairs that share a rare token are found by it; pairs that share
    common tokens only by :func:`_common_pairs`, class by class. The result is exact.
    """
    s = _texts(sources, model.source_fields, model.feature_type, model.ignore_missing)
    t = _texts(targets, model.target_fields, model.feature_type, model.ignore_missing)
    s = s.select(F.col(source_id).alias("source_id"), "_features").where(F.size("_features") > 0)
    t = t.select(F.col(target_id).alias("target_id"), "_features").where(F.size("_features") > 0)
    rows = materialize(s.withColumn("_source", F.lit(True)).unionByName(
        t.withColumn("_source", F.lit(False)), allowMissingColumns=True), "match")
    # Lists of features travel to be told apart and to be weighed; elsewhere their numbers stand for them.
    names = _numbered(rows.groupBy("_features").agg(
        F.max("_source").alias("_s"), F.min("_source").alias("_only_source"),
        F.min(F.when(~F.col("_source"), F.struct("target_id")))["target_id"].alias("_lowest")), "_id")
    ids = materialize(rows.join(names.select("_features", "_id"), "_features").select(
        "source_id", "target_id", "_source", F.col("_id").alias("_features")), "match")
    s, t = ids.where("_source").select("source_id", "_features"), ids.where("NOT _source").select("target_id", "_features")

    weights = materialize(_weights(names, model.feature_type), "match")
    ends = names.select("_id", "_s", "_only_source", "_lowest")
    vectors = materialize(_vectors(names, weights).join(ends, "_id").withColumnRenamed("_id", "_features"), "match")
    s_vectors, t_vectors = vectors.where("_s").drop("_lowest"), vectors.where("NOT _only_source")

    limit, any_common = _common_limit(vectors)
    copies = materialize(_lowest_ids(t, num_matches), "match")

    def find(open_sources, band):
        return _top(_scored_pairs(open_sources, t_vectors, band, limit), copies, num_matches), band

    bands = [b for b in _BANDS if b > score_threshold] + [score_threshold]
    # Each band reads all targets. Where few pairs share a rare token one pass costs less.
    met = weights.where(F.col("df") <= limit).agg(F.sum(F.col("df").cast("double") * F.col("df"))).first()[0]
    if (met or 0.0) <= _FEW_PAIRS * names.count():
        bands = bands[-1:]
    best = _by_band(s_vectors, find, num_matches, bands)
    if any_common:
        # Sharing common tokens only scores at most their joint norm.
        common = F.filter("_vec", lambda e: e["df"] > limit)
        most = F.sqrt(F.aggregate(common, F.lit(0.0), lambda acc, e: acc + e["w"] * e["w"]))
        full = best.where(F.col("rank") == num_matches).select(F.col("_sf").alias("_features"), "score")
        unsettled = s_vectors.join(full, "_features", "left").where(
            (F.size(common) > 0) & (most >= F.lit(score_threshold - 1e-9))
            & (F.col("score").isNull() | (F.col("score") <= most + F.lit(1e-8)))
        ).drop("score")
        unsettled = materialize(unsettled, "match")
        if not unsettled.isEmpty():
            more = _common_pairs(unsettled, t_vectors, copies, limit, num_matches, score_threshold)
            best = _merged_top(best.drop("rank"), more, num_matches)
    by_source = s.join(best.withColumnRenamed("_sf", "_features"), "_features")
    return by_source.select("source_id", "target_id", "score", "rank")


def match_results(sources: DataFrame, pairs: DataFrame, source_id: str = "id") -> DataFrame:
    """One row per source: ``(source_id, matches array<struct<score, target_id>>)``, empty where none."""
    grouped = pairs.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "target_id"))).alias("_m")
    )
    found = sources.select(F.col(source_id).alias("source_id")).join(grouped, "source_id", "left")
    matches = F.transform(F.coalesce("_m", F.array().cast(grouped.schema["_m"].dataType)),
                          lambda m: F.struct(m["score"].alias("score"), m["target_id"].alias("target_id")))
    return found.select("source_id", matches.alias("matches"))


# ------------------------------------------------------------------- supervised

_SIMILARITIES = ("simple", "insensitive", "bigram", "bigramextratokenizers")


def _named(df: DataFrame, fields: Sequence[str], alias: str) -> DataFrame:
    """``(<alias>_id, _name)``: the match fields as one text."""
    name = F.concat_ws(" ", *[F.col(f).cast("string") for f in fields])
    return df.select(F.col("id").alias(f"{alias}_id"), name.alias("_name"))


def _set_cosine(a: Column, b: Column) -> Column:
    a, b = F.array_distinct(a), F.array_distinct(b)
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.coalesce(F.try_divide(shared, F.sqrt(F.size(a).cast("double") * F.size(b))), F.lit(0.0))


def _similarities(source: str, target: str, kinds: Iterable[str] = _SIMILARITIES) -> list[Column]:
    return [
        _set_cosine(name_features(F.col(source), k), name_features(F.col(target), k)).alias(f"sim_{k}")
        for k in kinds
    ]


def fit_supervised(sources: DataFrame, targets: DataFrame, true_matches: DataFrame, model: MatchModel,
                   per_source: int = 5):
    """Logistic regression over name similarities; ``true_matches(source_id, target_id)`` are the positives.

    Negatives are the nearest other targets of the labelled sources. Coefficients are
    kept from going negative: a more similar pair never scores lower.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import Matrices

    labelled = sources.join(true_matches.select(F.col("source_id").alias("id")).distinct(), "id", "left_semi")
    relaxed = MatchModel(model.source_fields, model.target_fields, "bigramextratokenizers", model.ignore_missing)
    near = match_pairs(labelled, targets, relaxed, per_source).select("source_id", "target_id")
    truth = true_matches.select("source_id", "target_id").distinct()
    wrong = near.join(truth, ["source_id", "target_id"], "left_anti")
    pairs = truth.withColumn("label", F.lit(1.0)).unionByName(wrong.withColumn("label", F.lit(0.0)))
    named = pairs.join(_named(labelled, model.source_fields, "source").withColumnRenamed("_name", "_s"), "source_id") \
        .join(_named(targets, model.target_fields, "target").withColumnRenamed("_name", "_t"), "target_id")
    training = materialize(named.select("label", *_similarities("_s", "_t")), "match")
    inputs = [f"sim_{k}" for k in _SIMILARITIES]
    floor = Matrices.dense(1, len(inputs), [0.0] * len(inputs))
    stages = [VectorAssembler(inputCols=inputs, outputCol="features"),
              LogisticRegression(regParam=0.01, maxIter=50, standardization=False, lowerBoundsOnCoefficients=floor)]
    return Pipeline(stages=stages).fit(training)


def predict_supervised(fitted, sources: DataFrame, targets: DataFrame, model: MatchModel, num_matches: int = 1,
                       score_threshold: float = 0.0) -> DataFrame:
    """As :func:`match_pairs`, scored by the fitted model.

    Pairs that share a rare token of any similarity are scored one by one. What a pair scores by common
    tokens depends only on these and on the numbers of tokens, so names equal in both are a class, and
    classes meet in place of names. Sources that have better matches than their common tokens could
    give leave before. Pairs without a shared token never match.
    """
    regression = fitted.stages[-1]
    base = float(regression.intercept)
    # A similarity without weight neither finds nor scores pairs.
    weights = {k: float(c) for k, c in zip(_SIMILARITIES, regression.coefficients) if c > 0}
    if not weights:
        raise ValueError("the model tells no pair from another; give more true matches")
    kinds = list(weights)

    def score(similarities: dict[str, Column]) -> Column:
        linear = F.lit(base)
        for kind, w in weights.items():
            linear = linear + F.lit(w) * similarities[kind]
        return 1 / (1 + F.exp(-linear))

    s = materialize(_named(sources, model.source_fields, "source"), "match")
    t = materialize(_named(targets, model.target_fields, "target"), "match")
    either = s.select("_name", F.lit(True).alias("_s")).unionByName(t.select("_name", F.lit(False).alias("_s")))
    names = _numbered(either.where(F.col("_name").isNotNull()).groupBy("_name").agg(
        F.max("_s").alias("_source"), F.min("_s").alias("_only_source")), "_id")
    tokens = [F.array_distinct(name_features(F.col("_name"), k)) for k in kinds]
    # The generator keeps the tokens of a name in one place, so they are cut once.
    cut = materialize(names.select("_id", "_source", "_only_source", F.explode(F.array(F.array(*tokens))).alias("_f")), "match")
    told = cut.select("_id", "_source", "_only_source", F.transform("_f", F.size).alias("_sizes"), F.posexplode("_f").alias("kind", "_l")) \
        .select("_id", "_source", "_only_source", "_sizes", "kind", F.explode("_l").alias("token"))
    # A token of one side only is never shared.
    df = materialize(told.groupBy("kind", "token").agg(
        F.count(F.lit(1)).alias("df"), F.max("_source").alias("_s"), F.min("_only_source").alias("_t"))
        .where(F.col("_s") & ~F.col("_t")).select("kind", "token", "df"), "match")
    rare = told.join(df.where(F.col("df") <= _COMMON_DF).drop("df"), ["kind", "token"])
    met = rare.where("_source").select("kind", "token", F.col("_id").alias("_sf")).join(
        rare.where("NOT _only_source").select("kind", "token", F.col("_id").alias("_tf")), ["kind", "token"])
    of = lambda number, lists: cut.select(F.col("_id").alias(number), F.col("_f").alias(lists))
    pairs = met.select("_sf", "_tf").distinct().join(of("_sf", "_sl"), "_sf").join(of("_tf", "_tl"), "_tf")
    direct = pairs.select("_sf", "_tf", score({
        k: _set_cosine(F.get("_sl", F.lit(n)), F.get("_tl", F.lit(n))) for n, k in enumerate(kinds)}).alias("score")) \
        .where(F.col("score") >= F.lit(score_threshold))
    t_ids = t.join(names.select("_name", "_id"), "_name").select(F.col("_id").alias("_features"), "target_id")
    best = _top(direct, _lowest_ids(t_ids, num_matches), num_matches)

    best = materialize(best, "match")

    common = told.join(df.where(F.col("df") > _COMMON_DF), ["kind", "token"])
    by_class = ["_sizes", "_common"]
    placed = materialize(common.groupBy("_id", "_source", "_only_source", "_sizes").agg(
        F.array_sort(F.collect_list(F.struct("kind", "token"))).alias("_common")), "match")
    size = lambda sizes, n: F.get(sizes, F.lit(n)).cast("double")
    held = lambda n: F.size(F.filter("_common", lambda e: e["kind"] == n)).cast("double")
    most = score({k: F.coalesce(F.sqrt(F.try_divide(held(n), size("_sizes", n))), F.lit(0.0)) for n, k in enumerate(kinds)})
    full = best.where(F.col("rank") == num_matches).select(F.col("_sf").alias("_id"), "score")
    s_members = placed.where("_source").withColumn("_most", most).join(full, "_id", "left").where(
        (F.col("_most") >= F.lit(score_threshold - 1e-8)) & (F.col("score").isNull() | (F.col("score") <= F.col("_most") + F.lit(1e-8))))
    s_members, t_members = materialize(s_members.select("_id", *by_class), "match"), placed.where("NOT _only_source")
    if not s_members.isEmpty():
        s_classes = _numbered(s_members.select(*by_class).distinct(), "_class")
        t_classes = _numbered(t_members.select(*by_class).distinct(), "_class")
        t_of_class = t_members.join(t_classes, by_class).select(F.col("_class").alias("_features"), F.col("_id").alias("_member")) \
            .join(t_ids.withColumnRenamed("_features", "_member"), "_member").select("_features", "target_id")
        copies = materialize(_lowest_ids(t_of_class, num_matches), "match")
        spread = lambda classes, end: classes.select(F.col("_class").alias(f"_{end}f"), F.explode("_common").alias("e")).select(
            f"_{end}f", "e.kind", "e.token")
        # Few bytes can mean many pairs, so the split goes by row, not by size.
        tasks = int(s.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shared = spread(s_classes, "s").repartition(tasks, "_sf").join(spread(t_classes, "t"), ["kind", "token"]).groupBy("_sf", "_tf").agg(
            *(F.count_if(F.col("kind") == n).cast("double").alias(f"_n{n}") for n in range(len(kinds))))
        sized = lambda classes, end: classes.select(F.col("_class").alias(f"_{end}f"), F.col("_sizes").alias(f"_{end}z"))
        both = shared.join(sized(s_classes, "s"), "_sf").join(sized(t_classes, "t"), "_tf")
        cosine = lambda n: F.coalesce(F.try_divide(F.col(f"_n{n}"), F.sqrt(size("_sz", n) * size("_tz", n))), F.lit(0.0))
        scored = both.select("_sf", "_tf", score({k: cosine(n) for n, k in enumerate(kinds)}).alias("score"))
        of_class = _top(scored.where(F.col("score") >= F.lit(score_threshold)), copies, num_matches)
        known = materialize(s_classes.join(of_class.withColumnRenamed("_sf", "_class"), "_class").select(
            *by_class, "target_id", "score"), "match")
        more = s_members.join(known, by_class).select(F.col("_id").alias("_sf"), "target_id", "score")
        best = _merged_top(best.drop("rank"), more, num_matches)
    by_source = s.join(names.select("_name", F.col("_id").alias("_sf")), "_name").join(best, "_sf")
    return by_source.select("source_id", "target_id", "score", "rank")
