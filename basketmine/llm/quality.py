"""Quality rules: robust multivariate outliers per language and source.

Each text gets a vector of logarithms: mean word length, symbols per word, duplicate lines per line, and
repeated words per word.  Counts enter with half an occurrence added, so that a text without any still
differs from others by its length, and every component has a spread of its own.  For every (lang, source)
group, every language and all documents together the minimum-covariance-determinant (MCD) mean and
covariance are sought: from two starts (medians with scales from absolute deviations; the same
with the correlations of the hyperbolic tangents of the standardised values), each concentrated on the ``CORE_SHARE``
nearest vectors until no determinant falls any more; the smallest determinant wins, and a factor
makes the median distance that of a normal sample.  A group's estimate is then shrunk towards its
language's and that towards the global one, with the weight n / (n + ``PRIOR``) for n vectors: a small source rests on
its language, a large one on itself, and no size switches anything.  A document that passes the base rules is
rejected when its squared Mahalanobis distance exceeds ``CUTOFF``.

Everything is DataFrame expressions: the text is read once, the small table of vectors is stored in the shared
checkpoint folder, all groups and both starts go through a step in one pass, and a
hot source only adds partial aggregates: no step collects or sorts a group.

Defined cases: a null or empty text has no words and fails the base rules; null
``lang``/``source`` form groups of their own; repeated rows are judged alike; columns of the input that have the name of
a result (``n_words`` and the other statistics, ``base_failed``, ``distance``, ``kept``) are replaced, all others
pass through untouched and may have any name not starting with ``_q_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SPACE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
FEATURES = ["_q_len", "_q_sym", "_q_dup", "_q_rep"]
#: resolution of each feature (standard deviation), added to the diagonal of every covariance: what a group of texts of
#: one length, with one line each, does not vary in
RESOLUTION = {"_q_len": 0.02, "_q_sym": 0.1, "_q_dup": 0.05, "_q_rep": 0.05}
CORE_SHARE = 0.75       # h of the MCD: share of a group that the estimate rests on
PRIOR = 50.0            # vectors that the estimate of the next larger group counts for
MAX_STEPS = 20          # concentration steps at most
FALL = 1e-3             # a determinant falls if its logarithm does so by this much
CUTOFF = 47.86          # squared distance: quantile 1 - 1e-9 of chi-square with 4 degrees of freedom (texts have heavier tails)
CHI2_MEDIAN = 3.3567    # median of chi-square with 4 degrees of freedom
BUCKET = 64             # distance histogram: buckets per unit of ln(1 + d2)
GRID = 256              # median grid: buckets per unit of a feature
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for use in ``body`` (a lambda over a one-element array)."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by the 3-word windows that occur at least twice in ``words``.

    Window hashes are sorted; only texts with equal neighbours go on to sort
    (hash, position) pairs and to add up the union of the covered words.
    """
    def window(w, i):
        return F.xxhash64(w[i], w[i + 1], w[i + 2])

    def covered(p):  # p: sorted positions of repeated windows
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-9).alias("last")), lambda a, x: F.struct(
            (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])

    def by_position(w):
        pairs = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                                         lambda i: F.struct(window(w, i).alias("h"), i.alias("i"))))
        return _let(pairs, lambda s: covered(F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j:
                     ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == s[j]["h"]))
                     | ((j < F.size(s) - 1) & (s[F.least(j + 1, F.size(s) - 1)]["h"] == s[j]["h"]))),
            lambda j: s[j]["i"]))))

    def any_equal(w):
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i))
        return _let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(
        _let(words, lambda w: F.when(any_equal(w), by_position(w)).otherwise(F.lit(0))))


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(F.translate(t, SPACE, " " * len(SPACE)), " "), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(F.translate(x, SPACE, " " * len(SPACE))) != "")
    out = (docs.withColumn("_q_words", words).withColumn("_q_lines", F.size(lines)).withColumn("_q_distinct", F.size(F.array_distinct("_q_words")))
           .withColumn("n_words", F.size("_q_words").cast("long"))
           .withColumn("word_chars", F.char_length(F.translate(t, SPACE, "")).cast("long"))
           .withColumn("n_symbols", (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"))
           .withColumn("n_dup_lines", _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
           .withColumn("n_repeat_words", _repeat_words(F.col("_q_words")).cast("long"))
           .drop("_q_words"))
    return out.withColumn("base_failed", (F.col("n_words") < 50)
                          | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vectors(df: DataFrame) -> DataFrame:
    """The feature columns (and no longer what only they need)."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return (df.withColumn("_q_len", F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n))
            .withColumn("_q_sym", F.log((F.col("n_symbols") + 0.5) / (n + 1)))
            .withColumn("_q_dup", F.log((F.col("n_dup_lines") + 0.5) / (F.col("_q_lines") + 1)))
            .withColumn("_q_rep", F.log((n - F.col("_q_distinct") + F.col("n_repeat_words") + 1) / (n + 1)))
            .drop("_q_lines", "_q_distinct"))


_D = range(len(FEATURES))
_PAIRS = [(i, j) for i in _D for j in range(i + 1)]
_PARAMS = [f"_q_m{i}" for i in _D] + [f"_q_c{i}{j}" for i, j in _PAIRS]
_FACTORS = [f"_q_m{i}" for i in _D] + [f"_q_l{i}{j}" for i, j in _PAIRS]


def _same_group(a: str, b: str) -> Column:
    return F.col(f"{a}.lang").eqNullSafe(F.col(f"{b}.lang")) & F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _groups(points: DataFrame) -> DataFrame:
    """``lang, source, _q_g2, _q_g1, _q_g0``: numbers of each group, its language and the whole, stored."""
    found = stored(points.select("lang", "source").distinct().withColumn("_q_g2", F.monotonically_increasing_id()))
    first = F.min("_q_g2").over(Window.partitionBy("lang"))
    return stored(found.withColumn("_q_g1", -2 - first).withColumn("_q_g0", F.lit(-1).cast("long")))


def _cut_by_share(rows: DataFrame, keys: list[str], value: Column, share: float, width: int) -> DataFrame:
    """``keys``, ``_q_cut``: the upper edge of the histogram bucket in which ``share`` of the rows of a key is reached.

    A histogram adds up in any order, so the cut does not depend on the
    partitioning; only (key, bucket) counts are shuffled.
    """
    hist = rows.groupBy(*keys, F.floor(value * width).alias("_q_b")).agg(F.count("*").alias("_q_n"))
    w = Window.partitionBy(*keys)
    run = hist.withColumn("_q_upto", F.sum("_q_n").over(w.orderBy("_q_b"))).withColumn("_q_all", F.sum("_q_n").over(w))
    return (run.where(F.col("_q_upto") >= share * F.col("_q_all")).groupBy(*keys)
            .agg(((F.min("_q_b") + 1) / F.lit(float(width))).alias("_q_cut")))


def _with_factor(params: DataFrame) -> DataFrame:
    """Cholesky factor and log determinant of the covariances, as one projection in SQL text: in Python a
    call to the JVM for each of these operators takes longer than the step itself."""
    factor: dict[tuple[int, int], str] = {}
    for j in _D:
        below = "".join(f" - power({factor[j, k]}, 2)" for k in range(j))
        factor[j, j] = f"sqrt(greatest(_q_c{j}{j}{below}, 1e-9D))"
        for i in range(j + 1, len(FEATURES)):
            dot = "".join(f" - {factor[i, k]} * {factor[j, k]}" for k in range(j))
            factor[i, j] = f"((_q_c{i}{j}{dot}) / {factor[j, j]})"
    det = " + ".join(f"ln({factor[j, j]})" for j in _D)
    return params.selectExpr("*", *[f"{c} AS _q_l{i}{j}" for (i, j), c in factor.items()], f"2 * ({det}) AS _q_det")


def _concentrated(near: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Mean, covariance (with the resolution on the diagonal), factor and determinant of the ``share`` of each key's rows
    that is nearest, and ``_q_was``, the determinant that the distances ``_q_d`` came from.

    Counts and moments of the histogram buckets of the distance add up in any order; the buckets of a key are
    then added up to the share: one pass over the vectors, and only (key, bucket) rows are shuffled.  Moments are
    taken around the means that the distances came from, so that nothing cancels.
    """
    off = [f"({f} - _q_m{i})" for i, f in enumerate(FEATURES)]
    sums = [f"sum({x}) AS _q_x{i}" for i, x in enumerate(off)] + [f"sum({off[i]} * {off[j]}) AS _q_y{i}{j}" for i, j in _PAIRS]
    means = [f"first(_q_m{i}) AS _q_m{i}" for i in _D]
    cells = near.groupBy(*keys, F.floor(F.col("_q_d") * BUCKET).alias("_q_b")).agg(
        *map(F.expr, ["count(1) AS _q_n", "first(_q_det) AS _q_was", *means, *sums]))
    w = Window.partitionBy(*keys)
    # the buckets before the one that reaches the share, and that one
    before = F.coalesce(F.sum("_q_n").over(w.orderBy("_q_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    core = cells.select("*", before.alias("_q_before"), F.sum("_q_n").over(w).alias("_q_all")).where(
        F.col("_q_before") < share * F.col("_q_all"))
    shares = [f"sum(_q_x{i}) / sum(_q_n) AS _q_x{i}" for i in _D] + [f"sum(_q_y{i}{j}) / sum(_q_n) AS _q_y{i}{j}" for i, j in _PAIRS]
    moved = core.groupBy(*keys).agg(*map(F.expr, ["first(_q_was) AS _q_was", *means, *shares]))
    resolution = {(i, i): f" + {RESOLUTION[f] ** 2!r}D" for i, f in enumerate(FEATURES)}
    return _with_factor(moved.selectExpr(
        *keys, "_q_was", *[f"_q_m{i} + _q_x{i} AS _q_m{i}" for i in _D],
        *[f"_q_y{i}{j} - _q_x{i} * _q_x{j}{resolution.get((i, j), '')} AS _q_c{i}{j}" for i, j in _PAIRS]))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor."""
    ys: list[str] = []
    for i, f in enumerate(FEATURES):
        dot = "".join(f" - _q_l{i}{k} * {ys[k]}" for k in range(i))
        ys.append(f"(({f} - _q_m{i}{dot}) / _q_l{i}{i})")
    return F.expr(" + ".join(f"{y} * {y}" for y in ys))


def _starts(points: DataFrame) -> DataFrame:
    """Both starts of every group: ``_q_g, _q_s`` and the estimate."""
    def halves(values: list[Column], rows: DataFrame) -> DataFrame:
        """A row per group with the median of each value."""
        each = rows.select("_q_g", F.posexplode(F.array(*values)).alias("_q_f", "_q_x"))
        cuts = _cut_by_share(each, ["_q_g", "_q_f"], F.col("_q_x"), 0.5, GRID)
        return cuts.groupBy("_q_g").agg(*[F.max(F.when(F.col("_q_f") == i, F.col("_q_cut"))).alias(f"_q_h{i}") for i in _D])

    # tables with a row per group are stored, so that Spark knows their size when it plans the joins onto the vectors
    middle = stored(halves([F.col(f) for f in FEATURES], points)).select("_q_g", *[F.col(f"_q_h{i}").alias(f"_q_m{i}") for i in _D])
    away = halves([F.abs(F.col(f) - F.col(f"_q_m{i}")) for i, f in enumerate(FEATURES)], points.join(middle, "_q_g"))
    wide = stored(middle.join(away, "_q_g").select("_q_g", *[f"_q_m{i}" for i in _D], *[
        F.greatest(1.4826 * F.col(f"_q_h{i}"), F.lit(RESOLUTION[f])).alias(f"_q_s{i}") for i, f in enumerate(FEATURES)]))
    bent = [F.tanh((F.col(f) - F.col(f"_q_m{i}")) / F.col(f"_q_s{i}")).alias(f"_q_t{i}") for i, f in enumerate(FEATURES)]
    scale = [f"_q_s{i}" for i in _D]
    joint = points.join(wide, "_q_g").select("_q_g", *bent).groupBy("_q_g").agg(
        *[(F.covar_pop(f"_q_t{i}", f"_q_t{j}") / F.greatest(F.stddev_pop(f"_q_t{i}") * F.stddev_pop(f"_q_t{j}"), F.lit(1e-9)))
          .alias(f"_q_r{i}{j}") for i, j in _PAIRS if i != j])
    wide = wide.join(joint, "_q_g")

    def covariance(start: int) -> list[Column]:
        """Correlations are drawn in by a tenth, which keeps the matrix regular."""
        return [(F.col(f"_q_s{i}") * F.col(f"_q_s{j}") * (F.lit(1.0) if i == j else F.col(f"_q_r{i}{j}") * (0.9 * start))).alias(f"_q_c{i}{j}")
                for i, j in _PAIRS]
    both = [_with_factor(wide.select("_q_g", F.lit(k).alias("_q_s"), *[f"_q_m{i}" for i in _D], *covariance(k))) for k in (0, 1)]
    return stored(both[0].unionByName(both[1]).drop(*scale))


def mcd_estimates(points: DataFrame, share: float = CORE_SHARE) -> DataFrame:
    """MCD of every group ``_q_g`` of ``points`` (``_q_g`` and the features): ``_q_g, _q_n``, mean and covariance, the latter
    scaled so that the group's median distance is that of a normal sample."""
    keys = ["_q_g", "_q_s"]
    est, found = _starts(points), []
    for step in range(MAX_STEPS):
        near = points.join(est.select(*keys, *_FACTORS, "_q_det"), "_q_g").withColumn("_q_d", F.log1p(_distance()))
        est = stored(_concentrated(near, keys, share))
        found.append(est)
        # the first step leaves a start, which is no estimate of a core
        if step and est.where(F.col("_q_det") < F.col("_q_was") - FALL).isEmpty():
            break
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    # the smallest determinant of all steps of both starts
    first = F.row_number().over(Window.partitionBy("_q_g").orderBy("_q_det", "_q_s", "_q_m0"))
    best = stored(whole.withColumn("_q_rank", first).where("_q_rank = 1").drop("_q_rank", "_q_s", "_q_was"))
    near = points.join(best.select("_q_g", *_FACTORS), "_q_g").select("_q_g", F.log1p(_distance()).alias("_q_d"))
    half = _cut_by_share(near, ["_q_g"], F.col("_q_d"), 0.5, BUCKET)
    sizes = points.groupBy("_q_g").agg(F.count("*").alias("_q_n"))
    k = F.expm1("_q_cut") / CHI2_MEDIAN
    return stored(best.join(half, "_q_g").join(sizes, "_q_g").select(
        "_q_g", "_q_n", *[f"_q_m{i}" for i in _D], *[(F.col(f"_q_c{i}{j}") * k).alias(f"_q_c{i}{j}") for i, j in _PAIRS]))


def _shrunk(own: DataFrame, prior: DataFrame, up: str) -> DataFrame:
    """Estimates of ``own`` (with the number ``up`` of the next larger group) drawn towards those of ``prior``."""
    there = prior.select(F.col("_q_g").alias(up), *[F.col(c).alias(c + "_p") for c in _PARAMS])
    w = F.col("_q_n") / (F.col("_q_n") + PRIOR)
    return own.join(there, up).select("_q_g", *[c for c in own.columns if c in ("_q_g1", "_q_g0") and c != up],
                                      *[(w * F.col(c) + (1 - w) * F.col(c + "_p")).alias(c) for c in _PARAMS])


def group_estimates(passed: DataFrame, share: float = CORE_SHARE) -> DataFrame:
    """``lang, source``, mean and Cholesky factor of every group of ``passed``, shrunk towards language and whole."""
    groups = _groups(passed)
    points = stored(passed.alias("p").join(groups.alias("g"), _same_group("p", "g")).select(
        F.explode(F.array("_q_g2", "_q_g1", "_q_g0")).alias("_q_g"), *FEATURES))
    est = mcd_estimates(points, share)
    tongues = groups.select(F.col("_q_g1").alias("_q_g"), "_q_g0").distinct()
    language = _shrunk(est.join(tongues, "_q_g"), est, "_q_g0")
    own = _shrunk(est.join(groups.select(F.col("_q_g2").alias("_q_g"), "_q_g1"), "_q_g"), language, "_q_g1")
    return stored(_with_factor(own).withColumnRenamed("_q_g", "_q_g2").join(groups.drop("_q_g1", "_q_g0"), "_q_g2").select("lang", "source", *_FACTORS))


def quality_rules(docs: DataFrame, text: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``distance`` (squared; null for base failures) and ``kept``.

    Estimates come from the documents that pass the base rules.  A document is rejected if it fails them,
    or if its distance from its group is above ``cutoff``."""
    return _judged(stored(_vectors(base_statistics(docs, text))), cutoff)


def _judged(scored: DataFrame, cutoff: float) -> DataFrame:
    est = group_estimates(scored.where(~F.col("base_failed")).select("lang", "source", *FEATURES))
    out = scored.alias("p").join(est.alias("g"), _same_group("p", "g"), "left").select("p.*", *[F.col(f"g.{c}") for c in _FACTORS])
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    keep = [c for c in scored.columns if not c.startswith("_q_") and c not in ("distance", "kept")]
    return out.select(*keep, "distance", (~F.col("base_failed") & (F.col("distance") <= cutoff)).alias("kept")) \
        .withColumn("kept", F.coalesce("kept", F.lit(False)))


def q_quality(spark, sf_dir: str) -> DataFrame:
    from .common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    scored = stored(_vectors(base_statistics(docs)).drop("text"))
    return _judged(scored, CUTOFF).select("doc_id", *STATISTICS, "base_failed", "kept")
